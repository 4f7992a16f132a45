"""Cross-tokenizer alignment against the tokenizer libraries on whole texts, and the perfect hash."""

import collections

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scoutlake.llm import token_alignment
from scoutlake.llm.perfect_hash import PerfectHash

SF = "/root/testdata/sf0.001"
SPACE = "▁"
EDGES = [
    None, "", " ", "  ", "\n", "\n\n", "a", " a", "a ", "a  \n", "\n  a\n\n b  c", "tab\tx\r\n y", "no break      x",
    "　 wide　\n　 x\x1c y", "piece " + SPACE + "mark", "<|endoftext|> <s> </s> <unk> <0x0A>", "é é ﬁ 你好 世界 🙂🙂 \x00",
    "don't we'll  I'VE 12 345, x.y", "x" * 5_000 + " " * 300 + "=" * 700, "ab ab ab\nab",
]


@pytest.fixture(scope="module")
def tokenizers():
    path = public_tokenizers.path
    return token_alignment.load(path("byte_bpe_50k.json"), public_tokenizers.PATTERN, path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def docs(spark):
    edges = [(None if i == 3 else -i, t) for i, t in enumerate(EDGES)] + [(-99, EDGES[-1])] * 2
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return real.unionAll(spark.createDataFrame(edges, "doc_id long, text string")).repartition(3).cache()


def whole_text_alignment(texts):
    """(facts, groups) of each text, from the libraries and plain loops."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    alphabet, documents, parts = token_alignment.byte_values(), collections.Counter(), []
    for text in texts:
        groups = []
        if text:
            whole = (" " + text).encode()
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
            pieces = [b.id_to_piece(i) for i in ids_b]
            bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in zip(ids_b, pieces)]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
                common, i, j = sorted(set(ends_a) & set(ends_b)), 0, 0
                for cut in common:
                    g, h = [], []
                    while i < len(ids_a) and ends_a[i] <= cut:
                        g.append(ids_a[i])
                        i += 1
                    while j < len(ids_b) and ends_b[j] <= cut:
                        h.append(ids_b[j])
                        j += 1
                    groups.append((g, h))
        parts.append(groups)
        documents.update({(x, y) for g, h in groups for x in g for y in h})
    best = collections.defaultdict(int)
    for (x, _), n in documents.items():
        best[x] = max(best[x], n)
    for groups in parts:
        links = [(x, y) for g, h in groups for x in g for y in h]
        facts = [
            sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(links),
            sum(documents[link] == best[link[0]] for link in links), sum(documents[link] for link in links),
        ]
        yield tuple(facts), ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)


@pytest.mark.parametrize("shard, group, block", [(1 << 18, 1 << 22, 1 << 22), (8_000, 4_000, 20_000)])
def test_alignment_equals_whole_texts(docs, tokenizers, shard, group, block):
    rows = docs.collect()
    expected = collections.Counter((r.doc_id, r.text, *found) for r, found in zip(rows, whole_text_alignment([r.text for r in rows])))
    clash = docs.withColumns({"groups": F.lit("taken"), "n_a": F.lit("taken"), "shard": F.lit(1)})
    table = token_alignment.pair_table(clash, tokenizers, shard=shard, group=group)
    found = collections.Counter()
    for r in token_alignment.align_documents(clash, tokenizers, table, block=block).collect():
        assert r.shard == 1
        found[(r.doc_id, r.text, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum), r.groups)] += 1
    assert found == expected


def test_pair_counts(spark, tokenizers):
    docs = spark.createDataFrame([("ab",), ("ab",), ("ab ab",), (None,)], "text string")
    counts = token_alignment.pair_counts(token_alignment.pair_table(docs, tokenizers)).collect()
    assert counts and {r.n_docs for r in counts} == {3}


def test_alignment_of_nothing(spark, tokenizers):
    docs = spark.createDataFrame([], "doc_id long, text string")
    table = token_alignment.pair_table(docs, tokenizers)
    assert token_alignment.align_documents(docs, tokenizers, table).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    table = token_alignment.pair_table(only, tokenizers)
    rows = token_alignment.align_documents(only, tokenizers, table).collect()
    assert [(r.n_a, r.count_sum, r.groups) for r in rows] == [(0, 0, "")] * 2


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1_000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(2**40, n, replace=False)
    slots = PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(n))


def test_perfect_hash_of_a_stranger_is_in_range():
    found = PerfectHash.build(np.arange(1_000))
    slots = found.slots(np.arange(5_000, 9_000))
    assert slots.min() >= -1 and slots.max() < 1_000
