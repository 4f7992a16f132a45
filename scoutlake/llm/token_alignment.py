"""Alignment of two tokenizers: byte-level BPE (A) and pieces with byte fallback (B).

Both see a space and the text. Byte offsets where tokens of both end cut the tokens
into groups, and all A-B token pairs of a group are linked. The count of an id pair is
the number of documents that hold it linked.

Texts are split where both tokenizers must break, so a segment is encoded once and
remembered: in front of a space or a line break that follows something else than
white space. A's pattern never takes white space behind a word into its token, and
`load` demands that no piece of B holds a space behind another character or a line
break at all. What is remembered is a cache and never a limit. The new segments of a
slice of documents are encoded in one go, as one text that breaks at the same places.

First pass: tasks count the distinct pairs of their documents. The distinct pairs are
dealt to shards of about `SHARD` keys by hash, and each shard gets a minimal perfect
hash. Counts become dense vectors indexed by it, one for each shard and group of
tasks, which are summed in a tree of `FAN` vectors a node. Second pass: documents are
aligned again and look up their pairs; the key kept in a slot must equal the pair. The
table goes to the workers in blocks of at most `BLOCK` pairs, one pass a block, so its
size is bounded however many pairs there are.

Texts that are null or empty, or whose bytes the tokens of B do not give back, have no
tokens: zeros, and an empty text of groups. Repeated rows count as documents of their
own. Columns named like an added one are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import bounded_batches, stored, text_slices, wider
from scoutlake.llm.perfect_hash import PerfectHash

SPACE = "▁"
SHARD, FAN, BLOCK = 1 << 18, 8, 1 << 22
# Partial counts that a task holds before it merges them, and rows of one group of partial counts.
HELD, GROUP = 1 << 20, 1 << 22
ROWS, TOGETHER = 256, 1 << 16
# Segments that a task remembers before it starts anew; a cache only.
SEGMENTS = 500_000
# A pair is the number `a * WIDE + b`; WIDE is more than any id.
WIDE = 1 << 20
# Dealing pairs to shards: a remainder that Spark and numpy agree on.
PRIME = 1_000_003
_SEGMENT = re.compile(r"[ \n]+[^ \n]*")
# White space of another kind in front of a cut, where A may take both into one token.
_ODD = re.compile(r"[^\S \n][ \n]")
FACTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
ADDED = ", ".join(f"{name} long" for name in FACTS) + ", groups string"


class Tokenizers(NamedTuple):
    """Ranks and pattern of A, the model file of B."""

    ranks: dict[bytes, int]
    pattern: str
    model: bytes


def byte_values() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the others follow from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


def load(byte_bpe: str, pattern: str, pieces: str) -> Tokenizers:
    """Reads the vocabulary file of A and the model of B, and checks what the method builds on."""
    with open(byte_bpe, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab, values = model["vocab"], byte_values()
    merged = [vocab["".join(pair if isinstance(pair, list) else pair.split(" "))] for pair in model["merges"]]
    if merged != list(range(len(vocab) - len(merged), len(vocab))):
        raise ValueError("the ids of the merged tokens do not follow the order of the merges")
    ranks = {bytes(values[c] for c in token): rank for token, rank in vocab.items()}
    with open(pieces, "rb") as file:
        proto = file.read()
    processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
    if processor.get_piece_size() >= WIDE:
        raise ValueError("too many pieces")
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if "\n" in piece or SPACE in piece.lstrip(SPACE):
            raise ValueError(f"a piece crosses a place where texts are split: {piece!r}")
    return Tokenizers(ranks, pattern, proto)


class Grown:
    """A numpy array that grows by doubling."""

    def __init__(self, *width: int):
        self.held, self.n = np.zeros((1_024, *width), np.int64), 0

    def extend(self, rows: np.ndarray) -> None:
        need = self.n + len(rows)
        if need > len(self.held):
            larger = np.zeros((max(need, 2 * len(self.held)), *self.held.shape[1:]), np.int64)
            larger[: self.n] = self.held[: self.n]
            self.held = larger
        self.held[self.n : need] = rows
        self.n = need


class Aligner:
    """Segments of texts, each aligned once and known by a number from then on.

    Without `lookup`, segments keep their distinct pair numbers. With it, (counts of pairs, whether each is
    the highest of its A id), they keep their facts and their groups as text.
    """

    def __init__(self, tokenizers: Tokenizers, lookup: Lookup | None = None):
        self.a = tiktoken.Encoding("a", pat_str=tokenizers.pattern, mergeable_ranks=tokenizers.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.model)
        self.anchor, self.lookup = len(self.b.encode("a")), lookup
        self.a_sizes = np.zeros(max(tokenizers.ranks.values()) + 1, np.int64)
        self.a_sizes[list(tokenizers.ranks.values())] = [len(token) for token in tokenizers.ranks]
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode())
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.names = list(map(str, range(max(len(self.a_sizes), len(self.b_sizes)))))
        self.forget()

    def forget(self) -> None:
        """Starts anew. Number 0 is any segment whose bytes B does not give back."""
        self.known: dict[str, int] = {}
        self.groups, self.facts, self.pairs, self.ends = [""], Grown(len(FACTS)), Grown(), Grown()
        self.facts.extend(np.zeros((1, len(FACTS)), np.int64))
        self.ends.extend(np.zeros(1, np.int64))

    @staticmethod
    def segments(text: str) -> list[str]:
        parts = _SEGMENT.findall(" " + text) if text else []
        if _ODD.search(text):
            joined: list[str] = []
            for part in parts:
                if joined and joined[-1][-1].isspace():
                    joined[-1] += part
                else:
                    joined.append(part)
            return joined
        return parts

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the segments of all texts one after another, how many each text has)."""
        if len(self.known) > SEGMENTS:
            self.forget()
        known, split = self.known, [self.segments(t) for t in texts]
        flat = list(chain.from_iterable(split))
        inner, held = [], 0
        for s in dict.fromkeys(flat):
            if s in known:
                continue
            if SPACE in s:
                known[s] = 0
            elif s[-1].isspace():
                # White space at an end would run into the next segment.
                self._align([s])
            else:
                inner.append(s)
                held += len(s)
                if held > TOGETHER:
                    self._align(inner)
                    inner, held = [], 0
        if inner:
            self._align(inner)
        return np.fromiter(map(known.__getitem__, flat), np.int64, len(flat)), np.array([len(parts) for parts in split])

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pairs of the segments one after another, how many each segment has)."""
        ends = self.ends.held
        first, n = np.where(numbers > 0, ends[numbers - 1], 0), np.where(numbers > 0, ends[numbers] - ends[numbers - 1], 0)
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        return self.pairs.held[at], n

    def _align(self, segments: list[str]) -> None:
        text = "".join(segments)
        a = self.a.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        # The model puts a space in front; a letter takes it, and its pieces go.
        b = np.array(self.b.encode("a" + text)[self.anchor :], np.int64)
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != text.encode():
            if len(segments) == 1:
                self.known[text] = 0
            else:
                for s in segments:
                    self._align([s])
            return
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        ends = np.cumsum([len(s.encode()) for s in segments])
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n, owner = len(segments), np.searchsorted(ends, cuts)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        keys, times, of_pair = self._pairs(a, b, a_group, b_group, len(cuts))
        self.known.update(zip(segments, range(self.ends.n, self.ends.n + n)))
        if self.lookup is None:
            self.ends.extend(self.pairs.n + np.searchsorted(owner[of_pair], np.arange(n), "right"))
            self.pairs.extend(keys)
            return
        self.ends.extend(np.zeros(n, np.int64))
        counts, is_best = self.lookup(keys)
        facts = [(owner, n_a), (owner, n_b), (owner, np.ones(len(cuts))), (owner, n_a * n_b)]
        facts += [(owner[of_pair], times * is_best), (owner[of_pair], times * counts)]
        self.facts.extend(np.stack([np.bincount(at, x, minlength=n).astype(np.int64) for at, x in facts], axis=1))
        lines, group_ends = self._group_texts(a, b, n_a, n_b), np.searchsorted(owner, np.arange(n), "right").tolist()
        self.groups += [";".join(lines[low:high]) for low, high in zip([0, *group_ends[:-1]], group_ends)]

    def _pairs(self, a, b, a_group, b_group, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair numbers, links of each, group of each), in order of the groups; ids that repeat in a group count once."""

        def distinct(ids, group):
            found, n = np.unique(group * WIDE + ids, return_counts=True)
            return found // WIDE, found % WIDE, n

        ga, ia, ta = distinct(a, a_group)
        gb, ib, tb = distinct(b, b_group)
        per_b = np.bincount(gb, minlength=groups)
        first_b = np.concatenate(([0], np.cumsum(per_b)[:-1]))
        repeat = per_b[ga]
        left = np.repeat(np.arange(len(ga)), repeat)
        within = np.arange(len(left)) - np.repeat(np.cumsum(repeat) - repeat, repeat)
        right = first_b[ga[left]] + within
        return ia[left] * WIDE + ib[right], ta[left] * tb[right], ga[left]

    def _group_texts(self, a, b, n_a, n_b) -> list[str]:
        a, b = ([*map(self.names.__getitem__, ids.tolist())] for ids in (a, b))
        out, i, j = [], 0, 0
        for x, y in zip(n_a.tolist(), n_b.tolist()):
            if x == y == 1:
                out.append(f"{a[i]}|{b[j]}")
            else:
                out.append(f"{','.join(a[i:i + x])}|{','.join(b[j:j + y])}")
            i, j = i + x, j + y
        return out


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.withColumn("shard", (F.col("key") % PRIME % shards).cast("int"))


def _first_pass(docs: DataFrame, tokenizers: Tokenizers, text: str) -> DataFrame:
    """(key, n, task): documents of a task that hold a pair; a task may give a pair more than once."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(tokenizers))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = Aligner(Tokenizers(*shared.value)), TaskContext.get().partitionId()
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate(keys), return_inverse=True)
            return found, np.bincount(at, np.concatenate(counts)).astype(np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[0]), pa.array(counts[0]), pa.array(np.full(len(keys[0]), task, np.int32))], ["key", "n", "task"]
            )

        for batch in batches:
            for _, texts in text_slices(batch, text, ROWS):
                numbers, sizes = aligner.of(texts)
                row = np.repeat(np.arange(len(texts)), sizes)
                broken = np.zeros(len(texts), bool)
                broken[row[numbers == 0]] = True
                numbers, row = numbers[~broken[row]], row[~broken[row]]
                pairs, n = aligner.pairs_of(numbers)
                # Once a document, however often it holds the pair.
                once = np.unique(np.repeat(row, n) * WIDE**2 + pairs) % WIDE**2
                found, n = np.unique(once, return_counts=True)
                keys.append(found)
                counts.append(n)
                held += len(found)
                if held > HELD:
                    found, n = merged()
                    keys, counts, held = [found], [n], len(found)
                    if held > HELD // 2:
                        yield rows()
                        keys, counts, held = [], [], 0
        if keys:
            found, n = merged()
            keys, counts = [found], [n]
            yield rows()

    return docs.select(text).mapInArrow(count, "key long, n long, task int")


def pair_table(docs: DataFrame, tokenizers: Tokenizers, text: str = "text", shard: int = SHARD, group: int = GROUP) -> DataFrame:
    """(shard, sizes, words, keys, counts): one row for each shard, keys and counts by slot; stored."""
    bounded_batches(docs.sparkSession)
    partial = stored(_first_pass(docs, tokenizers, text), "pair-parts")
    distinct = stored(partial.select("key").distinct(), "pair-keys")
    # Both counts come from the footers of the files.
    shards = 1 + distinct.count() // shard
    groups = 1 + partial.count() // (shards * group)

    def build(rows: pa.Table) -> pa.Table:
        keys = rows.column("key").to_numpy()
        found = PerfectHash.build(keys)
        by_slot = np.empty_like(keys)
        by_slot[found.slots(keys)] = keys
        return pa.table({
            "shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()),
            "sizes": pa.array([found.sizes], pa.list_(pa.int64())),
            "words": pa.array([found.words.tobytes()], pa.binary()),
            "keys": pa.array([by_slot], pa.list_(pa.int64())),
        })

    built = _sharded(distinct, shards).groupBy("shard").applyInArrow(
        build, "shard int, sizes array<long>, words binary, keys array<long>"
    )
    hashes = stored(built, "pair-hashes")

    def fill(rows: pa.Table, hashed: pa.Table) -> pa.Table:
        found, keys = _hash_of(hashed.to_pylist()[0]), rows.column("key").to_numpy()
        n = int(np.bitwise_count(found.words).sum())
        vector = np.bincount(found.slots(keys), rows.column("n").to_numpy(), minlength=n).astype(np.int64)
        return pa.table({
            "shard": pa.array([hashed.column("shard")[0].as_py()], pa.int32()),
            "part": pa.array([hashed.column("part")[0].as_py()], pa.int32()),
            "v": pa.array([vector], pa.list_(pa.int64())),
        })

    parts = _sharded(partial, shards).withColumn("part", F.pmod("task", F.lit(groups)).cast("int"))
    small = hashes.select("shard", "sizes", "words", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"))
    # A shard that no task of a group has counted gives no row on the left, and no vector.
    present = small.join(parts.select("shard", "part").distinct(), ["shard", "part"], "left_semi")
    vectors = parts.groupBy("shard", "part").cogroup(present.groupBy("shard", "part")).applyInArrow(
        fill, "shard int, part int, v array<long>"
    )

    def add(rows: pa.Table) -> pa.Table:
        flat = rows.column("v").combine_chunks()
        total = flat.flatten().to_numpy().reshape(rows.num_rows, -1).sum(axis=0)
        return pa.table({
            "shard": rows.column("shard").slice(0, 1), "part": rows.column("part").slice(0, 1),
            "v": pa.array([total], pa.list_(pa.int64())),
        })

    while groups > 1:
        groups = -(-groups // FAN)
        above = vectors.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        vectors = above.groupBy("shard", "part").applyInArrow(add, "shard int, part int, v array<long>")
    return stored(hashes.join(vectors.select("shard", F.col("v").alias("counts")), "shard"), "pair-table")


def _hash_of(row: dict) -> PerfectHash:
    return PerfectHash.of_words(np.array(row["sizes"], np.int64), np.frombuffer(row["words"], np.uint64))


def pair_counts(table: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs) of a pair table: the alignment of the two vocabularies."""
    pairs = table.select(F.explode(F.arrays_zip("keys", "counts")).alias("p"))
    key = F.col("p.keys")
    return pairs.select(
        F.shiftright(key, 20).cast("int").alias("a_id"), (key % WIDE).cast("int").alias("b_id"),
        F.col("p.counts").alias("n_docs"),
    )


class Lookup:
    """A block of the pair table: shard -> (sizes, words, keys, counts); and the highest count of each A id."""

    def __init__(self, shards: dict[int, tuple], n_shards: int, highest: np.ndarray):
        self.n_shards, self.highest = n_shards, highest
        self.shards = {s: (PerfectHash.of_words(x, y), keys, n) for s, (x, y, keys, n) in shards.items()}

    def __call__(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts, shard_of = np.zeros(len(pairs), np.int64), pairs % PRIME % self.n_shards
        for shard in np.unique(shard_of).tolist():
            if shard in self.shards:
                found, keys, n = self.shards[shard]
                here = np.flatnonzero(shard_of == shard)
                slots = found.slots(pairs[here])
                right = (slots >= 0) & (keys[slots] == pairs[here])
                counts[here[right]] = n[slots[right]]
        return counts, (counts > 0) & (counts == self.highest[pairs // WIDE])


def _second_pass(docs: DataFrame, tokenizers: Tokenizers, text: str, block: tuple, again: bool) -> DataFrame:
    """Aligns and looks up; `again` adds the counts of one more block to those of the blocks before."""
    shared = docs.sparkSession.sparkContext.broadcast((tuple(tokenizers), block))
    names = [*FACTS, "groups"]
    schema = docs.schema if again else wider(docs, ADDED)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given, held = shared.value
        aligner = Aligner(Tokenizers(*given), Lookup(*held))
        for batch in batches:
            for part, texts in text_slices(batch, text, ROWS):
                numbers, sizes = aligner.of(texts)
                sums, groups = np.zeros((len(texts), len(FACTS)), np.int64), []
                some, starts = np.flatnonzero(sizes), np.cumsum(sizes) - sizes
                if len(some):
                    sums[some] = np.add.reduceat(aligner.facts.held[numbers], starts[some])
                    whole = np.add.reduceat(numbers == 0, starts[some]) == 0
                    sums[some[~whole]] = 0
                listed = numbers.tolist()
                for row, (start, n) in enumerate(zip(starts.tolist(), sizes.tolist())):
                    at = listed[start : start + n] if sums[row, 0] else []
                    groups.append(";".join(map(aligner.groups.__getitem__, at)))
                columns = dict(zip(part.schema.names, part.columns))
                if again:
                    for at, name in ((4, "n_best"), (5, "count_sum")):
                        columns[name] = pa.array(columns[name].to_numpy() + sums[:, at])
                else:
                    columns |= dict(zip(names, [*map(pa.array, sums.T.copy()), pa.array(groups, pa.string())]))
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(align, schema)


def align_documents(
    docs: DataFrame, tokenizers: Tokenizers, table: DataFrame, text: str = "text", block: int = BLOCK
) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups (`a1,a2|b1;a3|b2,b3`)."""
    bounded_batches(docs.sparkSession)
    added = [*FACTS, "groups"]
    if text in added:
        raise ValueError(f"the text cannot be called one of {added}")
    # One row a shard, and one number for each id of A.
    sizes = {r.shard: r.n for r in table.select("shard", F.size("keys").alias("n")).collect()}
    best = pair_counts(table).groupBy("a_id").agg(F.max("n_docs").alias("n")).toArrow()
    highest = np.zeros(max(tokenizers.ranks.values()) + 1, np.int64)
    highest[best.column("a_id").to_numpy()] = best.column("n").to_numpy()
    rounds: list[list[int]] = [[]]
    for shard, n in sorted(sizes.items()):
        if rounds[-1] and sum(sizes[s] for s in rounds[-1]) + n > block:
            rounds.append([])
        rounds[-1].append(shard)
    out = docs.drop(*added)
    for at, shards in enumerate(rounds):
        held = {}
        # At most `block` pairs, or one shard.
        for r in table.filter(F.col("shard").isin(shards)).toArrow().to_batches() if shards else ():
            for i in range(r.num_rows):
                sizes_of, words = np.array(r["sizes"][i].as_py(), np.int64), np.frombuffer(r["words"][i].as_py(), np.uint64)
                held[r["shard"][i].as_py()] = (sizes_of, words, r["keys"][i].values.to_numpy(), r["counts"][i].values.to_numpy())
        looked_up = _second_pass(out, tokenizers, text, (held, max(sizes, default=0) + 1, highest), bool(at))
        out = stored(looked_up, f"aligned-{at}") if at + 1 < len(rounds) else looked_up
    return out
