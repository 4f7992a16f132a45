"""Operators for training data against brute force, on small tables with nulls, ties, repeats and clashing names."""

import collections
import hashlib
import math
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from scoutlake.llm import attention_lm, byte_bpe, fingerprints, grid_join, licences, mixing, path_dedup, quality_net, token_counts, toxic_crf
from scoutlake.llm.components import components

SF = "/root/testdata/sf0.001"
EXTRA = [(None, None), (-1, ""), (-5, None), (-2, "a b"), (-3, "A  b"), (-3, "A  b"), (-4, "b"), (-6, "x y z w\n" * 900)]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return real.unionAll(spark.createDataFrame(EXTRA, "doc_id long, text string")).repartition(3).cache()


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def empty(spark, ddl="doc_id long, text string"):
    return spark.createDataFrame([], ddl)


@pytest.mark.parametrize("chunk, overlap", [(32_768, 1_024), (300, 24), (50, 8)])
def test_byte_bpe_round_trip(docs, ranks, chunk, overlap):
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    clash = docs.withColumn("ids", F.lit("taken")).withColumn("_x", F.lit(1))
    encoded = byte_bpe.encode_documents(clash, ranks, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
    rows = byte_bpe.decode_documents(encoded, ranks).collect()
    assert len(rows) == docs.count()
    for row in rows:
        text = row.text or ""
        assert list(row.ids) == encoding.encode_ordinary(text) and bytes(row.decoded) == text.encode()


def test_byte_bpe_of_nothing(spark, ranks):
    assert byte_bpe.encode_documents(empty(spark), ranks, public_tokenizers.PATTERN).count() == 0


def exact_components(sets, percent):
    ids = [i for i in sets if i is not None and sets[i]]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("leaf", [48, 2])
def test_path_dedup_equals_brute_force(spark, docs, leaf):
    base = [f"w{i}" for i in range(120)]
    near = [(500_000 + k, " ".join([*base[:k], "edit", *base[k + 1:]])) for k in range(0, 120, 8)]
    rows = docs.unionAll(spark.createDataFrame(near, "doc_id long, text string"))
    sets = {}
    for row in rows.collect():
        w = (row.text or "").encode().lower().split()
        sets[row.doc_id] = {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}
    expected = exact_components(sets, 85)
    for row in path_dedup.near_duplicates(rows, 3, 85, leaf=leaf).collect():
        assert row.n_shingles == len(sets[row.doc_id])
        assert row.component_id == expected.get(row.doc_id, row.doc_id)
        assert row.kept == (row.component_id == row.doc_id)


def test_path_dedup_of_nothing(spark):
    assert path_dedup.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 21)} | {100 + i: 100 for i in range(1, 30)}


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.15 * rng.normal(size=8)).tolist(), int(i % 2)) for i in range(120)]
    rows += [(1_000, None, 1), (1_001, [0.0] * 8, 1), (1_002, rows[0][1], None), (1_003, rows[0][1], 0), (1_004, [float("nan")] * 8, 1), (1_005, [1.0, 2.0], 1)]
    good = [(i, np.array(v), c) for i, v, c in rows if v and c is not None and np.isfinite(v).all() and any(v)]
    links, near = collections.Counter(), {i: {i} for i, _, _ in rows}
    for i, u, c in good:
        for j, v, d in good:
            if i != j and c == d and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.93:
                links[i] += 1
                near[i].add(j)
    root = {i: i for i in near}
    changed = True
    while changed:
        lower = {i: min(root[j] for j in near[i]) for i in near}
        changed, root = lower != root, lower
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for row in grid_join.near_vectors(table, block=16, fan=2).collect():
        assert (row.n_links, row.component_id, row.kept) == (links[row.vec_id], root[row.vec_id], root[row.vec_id] == row.vec_id)


def test_licences_base_equals_brute_force(spark, docs):
    more = [(-9, "MIT License mit-license mıt license"), (-10, "The mIt. LICENSE K x Apache License, É"), (-11, "Licensed under CC BY-NC 4.0.")]
    rows = docs.unionAll(spark.createDataFrame(more, "doc_id long, text string"))

    def brute(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
        at = [i for i, _ in places]
        return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({c for _, c in places}))

    want = collections.Counter((r.doc_id, *brute(r.text)) for r in rows.collect())
    found = licences.scan(rows).collect()
    assert want == collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.labels for r in found if r.doc_id == -11} == {"cc-by-nc"}
    assert licences.scan(empty(spark)).count() == 0


def test_licence_matches_equal_brute_force(spark, docs):
    # Prose with more than a dozen licence words rarer than the notice that stands in it whole.
    prose = "copyright rights reserved hereby granted charge person obtaining copy redistribution source binary forms unencumbered mozilla creative"
    more = [(10_000 + i, "Released under the MIT License.") for i in range(60)]
    more += [(20_000, f"{prose} Released under the MIT License."), (20_001, f"{prose} under the mit license, {prose} licensed under cc by sa 4.0")]
    rows = docs.unionAll(spark.createDataFrame(more, "doc_id long, text string")).collect()
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")) for r in rows]
    df = collections.Counter(w for found in words for w in set(found))
    want = collections.Counter()
    for row, found in zip(rows, words):
        matches = []
        for label, phrase, body in licences.TEMPLATES:
            body, key = body.split(), phrase.split()
            offset = next(i for i in range(len(body)) if body[i:i + len(key)] == key)
            idf = [math.log((len(rows) + 1) / df[w] + 1) if df[w] else 0 for w in body]
            for at in range(len(found)):
                if found[at:at + len(key)] == key:
                    stands = [0 <= at - offset + i < len(found) and found[at - offset + i] == w for i, w in enumerate(body)]
                    matches.append((label, at, round(sum(x for x, y in zip(idf, stands) if y) / sum(idf), 4)))
        want[(row.doc_id, max((m[2] for m in matches), default=0), tuple(matches))] += 1
    table = spark.createDataFrame(rows, "doc_id long, text string")
    scanned = licences.scan(table).collect()
    assert {r.score for r in scanned if r.doc_id == 20_000} == {1.0}
    assert want == collections.Counter((r.doc_id, round(r.score, 4), tuple((m.label, m.start, round(m.share, 4)) for m in r.matches)) for r in scanned)


def test_fingerprints(spark, docs):
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    expected = collections.Counter()
    for row, after in zip(rows, [*rows[1:], rows[0]]):
        text, more = row.text or "", after.text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + more[:half]
        expected[(row.doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    found = fingerprints.edited_fingerprints(docs).collect()
    assert expected == collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert np.mean([r.near_edited for r in found]) > 0.4 > np.mean([r.near_next for r in found])
    assert len({r.fingerprint for r in found if r.doc_id == -3}) == 1
    assert fingerprints.edited_fingerprints(empty(spark)).count() == 0


def test_likeness_equals_brute_force(spark):
    """Short texts inside long ones, whose fingerprints may be empty, and long ones, which are estimated."""
    rng = np.random.default_rng(5)
    long = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) for n in (40, 400, 400, 400)]
    rows = [(10 * i + j, text) for i, whole in enumerate(long) for j, text in enumerate(
        [" ".join(whole.split()[3:15]), whole, " ".join(whole.split()[-9:]), "", " ".join(whole.split()[:3])])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def whole(text):
        words = text.lower().split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}

    def part(a, b):
        return len(a & b) / min(len(a), len(b)) if a and b else float(a == b)

    found = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    exact = 0
    for (doc_id, text), (next_id, after) in zip(rows, [*rows[1:], rows[0]]):
        mine, other = ({*r.split(",")} - {""} for r in (found[doc_id].fingerprint, found[next_id].fingerprint))
        want = part(mine, other) if mine and other else part(whole(text), whole(after))
        assert found[doc_id].near_next == pytest.approx(want), doc_id
        exact += not mine
    assert exact > 4
    # A text that stands whole in the next one is contained in it, whatever its fingerprint holds.
    assert [found[10 * i].near_next for i in range(4)] == [1.0] * 4


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (i % 7), ["a", "b", None, "é"][i % 4] if i % 10 else "hot") for i in range(400)]
    rows += [(None, "x y", "a"), (3, None, "b"), (3, None, "b")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(table).cache()
    assert mixed.count() == len(rows)
    for row in mixed.groupBy("source", "source_size", "target").agg(F.sum("taken").alias("taken")).collect():
        assert row.taken == math.floor(row.target) and row.target <= 2 * row.source_size
    assert mixed.filter("taken > 2 * size").count() == 0
    again = {tuple(r) for r in mixing.mix(table.repartition(5)).select("doc_id", "source", "taken").collect()}
    assert again == {tuple(r) for r in mixed.select("doc_id", "source", "taken").collect()}
    out = mixing.repeated(mixed, table.columns)
    assert out.agg(F.sum(mixing.word_count("text"))).first()[0] == mixed.agg(F.sum("taken")).first()[0]
    assert mixing.mix(empty(spark, "doc_id long, text string, source string")).count() == 0


def test_quality_learns_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_net.score_documents(docs, quality_net.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert quality_net.fit(empty(spark), labels) is None


def test_marginals_equal_the_plain_recursion():
    rng = np.random.default_rng(1)
    moves = np.log(np.array([[0.9, 0.2], [0.5, 0.7]]))
    scores = [rng.normal(size=n) for n in (1, 5, 64, 65, 200)] + [np.zeros(0)]
    for s, p in zip(scores, toxic_crf.marginals(scores, moves)):
        steps = [np.exp(moves) * np.array([1, np.exp(x)]) for x in s]
        for i in range(len(s)):
            ahead, back = np.array([1.0, 0.0]), np.ones(2)
            for m in steps[: i + 1]:
                ahead = ahead @ m / (ahead @ m).sum()
            for m in steps[:i:-1]:
                back = m @ back / (m @ back).sum()
            assert p[i] == pytest.approx((ahead * back)[1] / (ahead * back).sum())


def test_toxic_spans(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = rng.choice(words, 40).tolist()
        if i % 4 == 0:
            text[int(rng.integers(40))] = "Scoundrel,"
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxic_crf.score_documents(docs, toxic_crf.fit(docs, marks)).collect()
    for row in found:
        assert row.predicted == int(row.doc_id % 4 == 0 and row.doc_id < 900)
        assert [row.text[s.start:s.end] for s in row.spans] == ["Scoundrel"] * row.predicted
    assert toxic_crf.fit(empty(spark), marks) is None


@pytest.mark.parametrize("head", [1 << 18, 50])
def test_unigram_base_equals_brute_force(monkeypatch, docs, ranks, head):
    monkeypatch.setattr(attention_lm, "HEAD", head)
    rows = docs.collect()
    tokens = {id(r): [*(r.text or "").encode().lower().split(), b"\n"] for r in rows}
    fold = lambda r: zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7
    counts = collections.Counter(w for r in rows if fold(r) != 2 for w in tokens[id(r)])
    total, distinct = sum(counts.values()), len(counts)
    expected = collections.Counter(
        (r.doc_id, fold(r) == 2, len(t), sum(w in counts for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), 4))
        for r in rows for t in [tokens[id(r)]]
    )
    found = attention_lm.score_documents(docs, ranks, public_tokenizers.PATTERN).collect()
    assert expected == collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found)
    assert all(r.score < 0 for r in found)


def test_windows_score_each_id_once():
    classes = np.arange(60, dtype=np.int32)
    for n in (0, 1, 30, 31, 32, 55, 56, 200):
        ids = np.arange(n) % 46
        _, targets = attention_lm.windows_of(ids, classes)
        assert targets[targets >= 0].tolist() == [*ids, attention_lm.END]


@pytest.mark.parametrize("digest", [5, -6])
def test_every_window_is_learned_from(spark, digest):
    ids = np.arange(400)
    table = spark.createDataFrame([(digest, ids.tolist(), True), (digest + 2, [500], True)], "digest long, ids array<int>, train boolean")
    # Ids differ, so the vector of an id moves only if a window that holds it was learned from.
    weights = np.random.default_rng(4).normal(0, 0.3, len(attention_lm.flat(attention_lm.first_weights(np.zeros(attention_lm.CLASSES))))).astype(np.float32)
    after = weights
    for turn in range(attention_lm.ROUNDS):
        after = attention_lm.train_round(table.coalesce(1), after, np.arange(1_000) % attention_lm.END, turn)
    moved = (attention_lm.shaped(after)["e"] != attention_lm.shaped(weights)["e"]).any(axis=1)
    assert np.flatnonzero(moved).tolist() == [*ids, 500, attention_lm.BEGIN]


def lm_example(n=400):
    rng = np.random.default_rng(5)
    first = attention_lm.first_weights(np.zeros(attention_lm.CLASSES))
    vector = (attention_lm.flat(first) + rng.normal(0, 0.2, len(attention_lm.flat(first)))).astype(np.float32)
    return vector, *attention_lm.windows_of(rng.integers(0, 60, n), np.arange(1_000) % attention_lm.END)


def lm_loss(vector, slots, targets):
    w, buffers = attention_lm.views(vector), attention_lm.Buffers()
    logs = attention_lm.log_shares(w, attention_lm.attend(w, slots, buffers).h, targets.ravel(), buffers)
    return -logs[targets.ravel() >= 0].astype(float).sum()


def test_slopes_equal_differences():
    vector, slots, targets = lm_example()
    slope = np.zeros_like(vector)
    assert attention_lm.add_slopes(attention_lm.views(vector), slots, targets, attention_lm.views(slope), attention_lm.Buffers()) == 401
    for name, part in attention_lm.views(slope).items():
        way = np.zeros_like(vector)
        attention_lm.views(way)[name][:] = part / np.linalg.norm(part) * 0.02
        found = (lm_loss(vector + way, slots, targets) - lm_loss(vector - way, slots, targets)) / 0.04
        assert found == pytest.approx(np.linalg.norm(part), rel=1e-2), name


def test_steps_reuse_their_arrays():
    vector, slots, targets = lm_example(attention_lm.BATCH * attention_lm.STRIDE - 1)
    w, g, buffers = attention_lm.views(vector), attention_lm.views(np.zeros_like(vector)), attention_lm.Buffers()
    attention_lm.add_slopes(w, slots, targets, g, buffers)
    tracemalloc.start()
    attention_lm.add_slopes(w, slots, targets, g, buffers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # One array of the class shares has as many bytes.
    assert peak < targets.size * attention_lm.CLASSES * 4


def test_shares_add_up_and_no_id_sees_a_later_one():
    vector, slots, targets = lm_example()
    w, buffers = attention_lm.views(vector), attention_lm.Buffers()
    rows = attention_lm.attend(w, slots, buffers).h.copy()
    each = [attention_lm.log_shares(w, rows, np.full(len(rows), c), buffers) for c in range(attention_lm.CLASSES)]
    np.testing.assert_allclose(np.exp(each).sum(axis=0), 1, rtol=1e-4)
    later = slots.copy()
    later[:, attention_lm.BACK + 10 :] = 7
    seen = attention_lm.attend(w, later, buffers).h.reshape(len(slots), attention_lm.STRIDE, -1)
    np.testing.assert_array_equal(seen[:, :10], rows.reshape(seen.shape)[:, :10])


def test_places_in_equals_binary_search():
    rng = np.random.default_rng(6)
    for n in (0, 1, 3_000):
        known = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        asked = np.concatenate([known, known + np.uint64(1), rng.integers(0, 1 << 64, 500, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        np.testing.assert_array_equal(attention_lm.places_in(known)(asked), np.searchsorted(known, asked))


def test_section_tokens_add_up(docs, ranks):
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = collections.Counter()
    for row in docs.collect():
        text = row.text or ""
        sections = [len(x.encode()) for x in re.findall(r"[^\n]*\n|[^\n]+", text)] or [0]
        counts, at = [0] * len(sections), 0
        ends = np.cumsum(sections)
        for i in encoding.encode_ordinary(text):
            counts[int(np.searchsorted(ends, at, "right"))] += 1
            at += len(encoding.decode_single_token_bytes(i))
        expected.update((row.doc_id, n, c) for n, c in enumerate(counts))
    found = token_counts.section_tokens(docs, ranks, public_tokenizers.PATTERN).collect()
    assert expected == collections.Counter((r.doc_id, r.section, r.n_tokens) for r in found)


def test_toxic_words_without_enough_evidence_are_still_learned(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*rng.choice(words, 20), *(["Scoundrel"] if i < 2 else []), *rng.choice(words, 20)])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 2)) for i in range(400)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxic_crf.score_documents(docs, toxic_crf.fit(docs, marks, held_out=-1)).collect()}
    assert min(scores[0], scores[1]) > max(s for i, s in scores.items() if i > 1)
