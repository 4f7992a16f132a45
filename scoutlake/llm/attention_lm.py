"""Language-model scores: causal self-attention on subword ids, beside a smoothed unigram base.

Base: counts of all training words (A-Z in lower case, plus one end per text). The
most frequent words, at most `HEAD`, are broadcast; every other word of a text meets
its count in an equi-join, so nothing is cut off.

Model: one layer of causal self-attention in numpy over the ids of a public
byte-level tokenizer. It predicts the class of the next id; the id inside its class
follows the counts of all training texts. Frequent ids are classes of their own, the
others are grouped by how their bytes look. Weights are fitted by local steps in every
task and averaged over the tasks. Each round takes another 1 in `ROUNDS` of a text's
windows, so after the last one every window of the training texts was learned from once.

A text is scored in windows of `WIDTH` ids that overlap by `BACK`: a window scores its
last `STRIDE` places, the first `BACK` are context alone (before the text: its begin), so
each id and the end of the text are scored once. Null texts are empty: they have the
end alone. Repeated rows are scored alike, each once; other columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import bounded_batches, id_fold, stored, text_slices

HEAD = 1 << 18
BUCKETS = 18  # leading bits of a hash that point to its place among the words of the head
DIMS, WIDTH, STRIDE = 16, 32, 24
BACK = WIDTH - STRIDE
LOW, HASHED = 2_048, 2_048  # a power of two
BEGIN = LOW + HASHED
SINGLES, GROUPS = 46, 16
CLASSES = SINGLES + GROUPS + 1
END = CLASSES - 1
ROUNDS, BATCH, RATE = 2, 64, 0.02
EARLY, MERGED = 200, 4
WINDOWS = 64
END_WORD = np.uint64(xxhash.xxh64_intdigest(b"\n"))
SEED = 11


class Tables(NamedTuple):
    """Class of each id, log10 share of the id in its class, log share of the classes."""

    classes: np.ndarray
    inside: np.ndarray
    prior: np.ndarray


# --- base -------------------------------------------------------------------


def _hashes(text: str) -> np.ndarray:
    found = text.encode("utf-8", "surrogatepass").lower().split()
    return np.append(np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found)), END_WORD)


def places_in(known: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """A function that is `np.searchsorted(known, hashes)`; hashes are spread evenly, so their first bits lead near."""
    shift = np.uint64(64 - BUCKETS)
    starts = np.searchsorted(known, np.arange(1 << BUCKETS, dtype=np.uint64) << shift)
    most = int(np.diff(np.append(starts, len(known))).max())
    padded = np.append(known, ~np.uint64(0))

    def find(hashes: np.ndarray) -> np.ndarray:
        at = starts[hashes >> shift]
        for _ in range(most):
            at += padded[at] < hashes
        return at

    return find


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): counts of the words of all texts, by 64-bit hash; one end per text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in batches:
            for _, texts in text_slices(batch):
                parts += [_hashes(t) for t in texts]
                held += sum(len(p) for p in parts[-len(texts):])
                if held > 4_000_000:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def base_scores(docs: DataFrame, counts: DataFrame, total: int, distinct: int, head: int | None = None) -> DataFrame:
    """(key, digest, n_tokens, n_known, base_score) per distinct (key, text)."""
    floor = np.log10(float(total + distinct + 1))
    # The least count such that at most `head` words have it or more, from counts per quarter octave.
    octave = F.floor(F.log2("n") * 4)
    steps = counts.groupBy(octave.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, taken = None, 0
    for row in sorted(steps, key=lambda r: -r.step):
        taken += row.words
        if taken > (HEAD if head is None else head):
            break
        least = row.least
    frequent = counts.filter(F.col("n") >= least) if least else counts.limit(0)
    table = frequent.toArrow().to_pandas()
    known = table["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    # Two arrays of at most `head` numbers.
    shared = docs.sparkSession.sparkContext.broadcast((known[order], np.log10(table["n"].to_numpy(float)[order] + 1)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs = shared.value
        find = places_in(known)
        for batch in batches:
            for part, texts in text_slices(batch):
                found = [_hashes(t) for t in texts]
                sizes = np.array([len(f) for f in found])
                words, row = np.concatenate(found), np.repeat(np.arange(len(texts)), sizes)
                at = np.minimum(find(words), max(len(known) - 1, 0))
                hit = known[at] == words if len(known) else np.zeros(len(words), bool)
                inside, at = row[hit], at[hit]
                row, words = row[~hit], words[~hit]
                order = np.lexsort((words, row))
                row, words = row[order], words[order]
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (words[1:] != words[:-1]))[: len(row)])
                # The row of the text itself goes to the task of a word that nobody has counted.
                own = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), seed=1) for t in texts]
                owner = pa.array(np.append(np.arange(len(texts)), row[first]))
                pad = np.zeros(len(first), np.int64)
                n_known = np.bincount(inside, minlength=len(texts))
                score = np.bincount(inside, logs[at], len(texts)) if len(at) else np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key").take(owner), part.column("digest").take(owner),
                        pa.array(np.append(np.array(own, np.uint64), words[first]).view(np.int64)),
                        pa.array(np.append(np.zeros(len(texts), np.int64), np.diff(np.append(first, len(row))))),
                        pa.array(np.append(sizes, pad)), pa.array(np.append(n_known, pad)), pa.array(np.append(score, pad)),
                    ],
                    ["key", "digest", "word", "times", "n_tokens", "n_known", "score"],
                )

    ddl = "key long, digest long, word long, times long, n_tokens long, n_known long, score double"
    rows = docs.select("key", "digest", "text").mapInArrow(look_up, ddl)
    # Words of the head never reach the join, so no word in it is frequent.
    rare = counts.filter(F.col("n") < least) if least else counts
    met = rows.join(rare, "word", "left")
    summed = met.groupBy("key", "digest").agg(
        F.count_if(F.col("times") == 0).alias("rows"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("score") + F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("score"),
    )
    # Equal rows of equal ids were summed together.
    each = F.greatest("rows", F.lit(1))
    return summed.select(
        "key", "digest",
        (F.col("n_tokens") / each).cast("long").alias("n_tokens"),
        (F.col("n_known") / each).cast("long").alias("n_known"),
        ((F.col("score") - F.col("n_tokens") * float(floor)) / each).alias("base_score"),
    )


# --- model ------------------------------------------------------------------


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, key, digest, train, ids) with the subword ids of the texts, A-Z in lower case, as the bytes of `id_kind`."""
    size = max(ranks.values()) + 1
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            for part, texts in text_slices(batch, rows=256):
                lower = [t.encode("utf-8", "replace").lower().decode("utf-8") for t in texts]
                found = [encoding.encode_to_numpy(t, disallowed_special=()).astype(id_kind(size)).tobytes() for t in lower]
                keep = [part.column(c) for c in ("doc_id", "key", "digest", "train")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.binary())], ["doc_id", "key", "digest", "train", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(encode, f"doc_id {kind}, key long, digest long, train boolean, ids binary")


def id_kind(size: int) -> np.dtype:
    """The type of ids below `size`."""
    return np.dtype("<u2" if size <= 1 << 16 else "<i4")


def _id_arrays(batch, size: int) -> list[np.ndarray]:
    """The ids of each row, from lists or from the bytes of `id_kind`."""
    column, kind = batch.column("ids"), id_kind(size)
    if pa.types.is_list(column.type):
        flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
        return np.split(flat, ends[:-1]) if len(ends) else []
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def id_tables(ids: DataFrame, ranks: dict[bytes, int]) -> Tables:
    """Classes and shares from the id counts of all training texts."""
    size = max(ranks.values()) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(size, np.int64), 0
        for batch in batches:
            total += np.bincount(np.concatenate([np.zeros(0, np.int64), *_id_arrays(batch, size)]), minlength=size)
            texts += batch.num_rows
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], texts))], ["id", "n"]
        )

    counted = ids.filter("train").select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts, ends = np.zeros(size), 0.0
    for row in counted.collect():  # as many rows as the tokenizer has ids
        if row.id < 0:
            ends = float(row.n)
        else:
            counts[row.id] = row.n
    by_count = np.argsort(-counts, kind="stable")
    rank = np.empty(size, int)
    rank[by_count] = np.arange(size)
    classes = np.full(size, SINGLES)
    for token, at in ranks.items():
        body = token.lstrip(b" ")
        kind = 0 if body.isalpha() and body.isascii() else 1 if any(c > 127 for c in body) else 2 if body.isdigit() else 3
        classes[at] = rank[at] if rank[at] < SINGLES else SINGLES + 8 * token.startswith(b" ") + 2 * kind + (rank[at] < 512)
    smooth = counts + 1
    inside = np.log10(smooth / np.bincount(classes, smooth, CLASSES)[classes])
    prior = np.bincount(classes, counts, CLASSES) + 1.0
    prior[END] += ends
    return Tables(classes.astype(np.int32), inside, np.log(prior / prior.sum()))


SHAPES = {"e": (BEGIN + 1, DIMS), "p": (WIDTH, DIMS), "q": (DIMS, DIMS), "k": (DIMS, DIMS), "v": (DIMS, DIMS), "o": (DIMS, DIMS), "u": (DIMS, CLASSES), "b": (CLASSES,)}


def first_weights(prior: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    w = {name: rng.normal(0, 0.3 if name == "e" else 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    w["u"] = np.zeros(SHAPES["u"], np.float32)
    # With `u` still zero the shares are the counted ones.
    w["b"] = (FOLD * (np.exp((prior - prior.max()) / FOLD) - 1)).astype(np.float32)
    return w


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[name].ravel() for name in SHAPES])


def shaped(vector: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name], at = vector[at : at + n].reshape(shape).astype(np.float32), at + n
    return out


def views(vector: np.ndarray) -> dict[str, np.ndarray]:
    """The parts of a flat vector, without a copy."""
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES.values()])
    return {name: part.reshape(shape) for (name, shape), part in zip(SHAPES.items(), np.split(vector, ends[:-1]))}


def window_count(ids: np.ndarray) -> int:
    return len(ids) // STRIDE + 1


def windows_of(ids: np.ndarray, classes: np.ndarray, chosen: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
    """Input slots (windows, WIDTH) and target classes (windows, STRIDE) of all or the chosen windows; -1 behind the end."""
    count = window_count(ids)
    slots = np.full(BACK + count * STRIDE, BEGIN, np.int32)
    slots[BACK + 1 : BACK + 1 + len(ids)] = np.where(ids < LOW, ids, LOW + (ids & (HASHED - 1)))
    targets = np.full(count * STRIDE, -1, np.int32)
    targets[: len(ids)] = classes[ids]
    targets[len(ids)] = END
    before, own = slots[:-BACK].reshape(-1, STRIDE)[chosen], slots[BACK:].reshape(-1, STRIDE)[chosen]
    return np.concatenate([before[:, :BACK], own], axis=1), targets.reshape(-1, STRIDE)[chosen]


# Shares of both normalisations are powers, (1 + z / FOLD) ** FOLD, which need two multiplications instead of a
# library call and no greatest value; whatever function is taken, the shares add up to 1.
FOLD, LEAST = 4, np.float32(0.02)
_SEEN = np.tril(np.ones((STRIDE, WIDTH), np.float32), BACK)
# Added and least values: places after the own one get a share of exactly 0.
_SHIFT, _LEAST = np.where(_SEEN > 0, 1, -1e9).astype(np.float32), LEAST * _SEEN


# Places of the numbers of each id in the flat vectors of all ids.
_NUMBERS = np.arange((BEGIN + 1) * DIMS).reshape(BEGIN + 1, DIMS)


class Buffers(dict):
    """Arrays of a task that every step uses again: fresh ones of this size cost more time than the arithmetic in them."""

    def of(self, name: str, *shape: int, kind: type = np.float32) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, kind)
        return self[name][:size].reshape(shape)


class Attended(NamedTuple):
    """Inputs, those that ask, queries, bases, powers, 1 / sums of powers, mixed inputs and output with a column of ones.

    `asked` has room for slopes, then the queries; `given` has the powers, then room for slopes.
    """

    x: np.ndarray
    own: np.ndarray
    asked: np.ndarray
    t: np.ndarray
    given: np.ndarray
    inverse: np.ndarray
    m: np.ndarray
    h: np.ndarray


def attend(w: dict[str, np.ndarray], slots: np.ndarray, buffers: Buffers) -> Attended:
    """Masked attention of the last `STRIDE` places of windows; rows of `h` are places.

    Queries meet keys as x q k' x', so q k' and v o are multiplied first and the inputs are projected once.
    """
    n = len(slots)
    rows = n * STRIDE
    x = np.take(w["e"], slots, axis=0, out=buffers.of("x", n, WIDTH, DIMS), mode="clip")
    x += w["p"]
    own = buffers.of("own", rows, DIMS)
    own.reshape(n, STRIDE, DIMS)[:] = x[:, BACK:]
    asked, given = buffers.of("asked", n, 2, STRIDE, DIMS), buffers.of("given", n, 2, STRIDE, WIDTH)
    y, a = asked[:, 1], given[:, 0]
    meet = w["q"] @ w["k"].T * np.float32(DIMS**-0.5 / FOLD)
    y[:] = np.matmul(own, meet, out=buffers.of("m", rows, DIMS)).reshape(y.shape)
    t = np.matmul(y, x.transpose(0, 2, 1), out=buffers.of("t", n, STRIDE, WIDTH))
    t += _SHIFT
    np.maximum(t, _LEAST, out=t)
    np.multiply(t, t, out=a)
    a *= a
    inverse = np.matmul(a, np.ones((WIDTH, 1), np.float32), out=buffers.of("inverse", n, STRIDE, 1)).reshape(rows, 1)
    np.divide(1, inverse, out=inverse)
    m = np.matmul(a, x, out=buffers.of("m", n, STRIDE, DIMS)).reshape(rows, DIMS)
    m *= inverse
    h = buffers.of("h", rows, DIMS + 1)
    np.add(np.matmul(m, w["v"] @ w["o"], out=buffers.of("out", rows, DIMS)), own, out=h[:, :DIMS])
    h[:, DIMS] = 1
    return Attended(x, own, asked, t, given, inverse, m, h)


def class_bases(w: dict[str, np.ndarray], h: np.ndarray, buffers: Buffers) -> np.ndarray:
    weights = np.vstack([w["u"], w["b"] + np.float32(FOLD)]) / np.float32(FOLD)
    t = np.matmul(h, weights, out=buffers.of("bases", len(h), CLASSES))
    return np.maximum(t, LEAST, out=t)


def log_shares(w: dict[str, np.ndarray], h: np.ndarray, targets: np.ndarray, buffers: Buffers) -> np.ndarray:
    """Natural log probabilities of the target classes."""
    t = class_bases(w, h, buffers)
    hit = t.ravel()[np.arange(len(h)) * CLASSES + targets]
    t *= t
    return FOLD * np.log(hit) - np.log(np.einsum("ij,ij->i", t, t))


def add_slopes(w: dict[str, np.ndarray], slots: np.ndarray, targets: np.ndarray, g: dict[str, np.ndarray], buffers: Buffers) -> int:
    """Adds the gradients of the loss, summed over the targets of some windows, to `g`; returns the number of targets."""
    x, own, asked, t, given, inverse, m, h = attend(w, slots, buffers)
    rows, parts, y, dt = len(h), asked[:, 0], asked[:, 1], given[:, 1]
    targets = targets.ravel()
    behind = targets < 0
    at = np.arange(rows) * CLASSES + targets
    base = class_bases(w, h, buffers)
    # Slope of log((1 + z / FOLD) ** FOLD): 1 / base; of the log of the sum: base ** (FOLD - 1) / sum.
    hit = 1 / base.ravel()[at]
    dz = np.multiply(base, base, out=buffers.of("dz", rows, CLASSES))
    base *= (1 / np.einsum("ij,ij->i", dz, dz))[:, None]
    dz *= base
    dz.ravel()[at] -= hit
    dz[behind] = 0
    du = dz.T @ h
    g["u"] += du[:, :DIMS].T
    g["b"] += du[:, DIMS]
    dh = np.matmul(dz, w["u"].T, out=buffers.of("dh", rows, DIMS))
    dm = np.matmul(dh, (w["v"] @ w["o"]).T, out=buffers.of("out", rows, DIMS))
    mixed = m.T @ dh
    g["v"] += mixed @ w["o"].T
    g["o"] += w["v"].T @ mixed
    m *= dm
    lean = m @ np.ones((DIMS, 1), np.float32)
    lean *= inverse
    dm *= inverse
    parts[:] = dm.reshape(parts.shape)
    np.matmul(parts, x.transpose(0, 2, 1), out=dt)
    dt -= lean.reshape(-1, STRIDE, 1)
    for _ in range(FOLD - 1):
        dt *= t
    # The factor `FOLD` of the power's slope is taken on the narrow side.
    y *= np.float32(FOLD)
    dy = np.matmul(dt, x, out=buffers.of("m", *y.shape)).reshape(rows, DIMS)
    dh += np.matmul(dy, (w["q"] @ w["k"].T * np.float32(DIMS**-0.5)).T, out=buffers.of("out", rows, DIMS))
    met = own.T @ dy * np.float32(DIMS**-0.5)
    g["q"] += met @ w["k"]
    g["k"] += met.T @ w["q"]
    dx = np.matmul(given.reshape(-1, 2 * STRIDE, WIDTH).transpose(0, 2, 1), asked.reshape(-1, 2 * STRIDE, DIMS), out=buffers.of("dx", *x.shape))
    dx[:, BACK:] += dh.reshape(y.shape)
    g["p"] += dx.sum(axis=0)
    places = np.take(_NUMBERS, slots, axis=0, out=buffers.of("places", *x.shape, kind=np.int64), mode="clip")
    np.add.at(g["e"].reshape(-1), places.reshape(-1), dx.reshape(-1))
    return rows - int(behind.sum())


def train_round(ids: DataFrame, weights: np.ndarray, classes: np.ndarray, turn: int) -> np.ndarray:
    """Local steps on this round's windows in every task, then the average by windows."""
    shared = ids.sparkSession.sparkContext.broadcast((weights, classes))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, classes = shared.value
        vector = start.astype(np.float32)
        mean, power, slope, change = (np.zeros_like(vector) for _ in range(4))
        w, g, buffers = views(vector), views(slope), Buffers()
        step, seen, held, count, targets, added = 0, 0, [], 0, 0, 0

        def gather() -> None:
            nonlocal targets, added
            targets += add_slopes(w, np.concatenate([s for s, _ in held]), np.concatenate([t for _, t in held]), g, buffers)
            added += 1

        def update() -> None:
            nonlocal step
            step += 1
            np.multiply(slope, np.float32(1 / max(targets, 1)), out=slope)
            np.subtract(slope, mean, out=change)
            np.multiply(change, np.float32(0.1), out=change)
            np.add(mean, change, out=mean)
            np.multiply(slope, slope, out=change)
            np.subtract(change, power, out=change)
            np.multiply(change, np.float32(0.01), out=change)
            np.add(power, change, out=power)
            np.sqrt(power, out=change)
            np.multiply(change, np.float32((1 - 0.99**step) ** -0.5), out=change)
            np.add(change, np.float32(1e-6), out=change)
            np.divide(mean, change, out=change)
            np.multiply(change, np.float32(RATE / (1 - 0.9**step)), out=change)
            np.subtract(vector, change, out=vector)
            slope.fill(0)

        for batch in batches:
            for key, found in zip(batch.column("digest").to_pylist(), _id_arrays(batch, len(classes))):
                chosen = slice((turn - key) % ROUNDS, None, ROUNDS)
                slots, aims = windows_of(found, classes, chosen)
                # A long text is taken in parts, so that no step grows with it.
                for at in range(0, len(slots), BATCH):
                    held.append((slots[at : at + BATCH], aims[at : at + BATCH]))
                    count += len(held[-1][0])
                    seen += len(held[-1][0])
                    if count >= BATCH:
                        gather()
                        held.clear()
                        count = 0
                        # After the first steps, the mean slope of several batches.
                        if added >= (1 if step < EARLY else MERGED):
                            update()
                            targets = added = 0
        if count:
            gather()
        if added:
            update()
        if seen:
            found = vector.astype(float) * seen
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, len(found), dtype=np.int32)), pa.array(np.append(float(seen), found))], ["at", "v"]
            )

    parts = ids.filter("train").select("digest", "ids").mapInArrow(learn, "at int, v double")
    # As many rows as the model has weights.
    found = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    if found.empty:
        return weights
    sums = np.empty(len(weights) + 1)
    sums[found["at"].to_numpy() + 1] = found["v"]
    return (sums[1:] / sums[0]).astype(np.float32)


def model_scores(ids: DataFrame, weights: np.ndarray, tables: Tables) -> DataFrame:
    """(doc_id, key, digest, train, score): log10 probability of every text and its end."""
    shared = ids.sparkSession.sparkContext.broadcast((weights, tuple(tables)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, tables = shared.value
        w, tables, buffers = shaped(weights), Tables(*tables), Buffers()
        for batch in batches:
            scores = []
            for start in range(0, batch.num_rows, 64):
                texts = _id_arrays(batch.slice(start, 64), len(tables.classes))
                cut = [windows_of(t, tables.classes) for t in texts]
                slots, targets = (np.concatenate(x) for x in zip(*cut))
                owner = np.repeat(np.arange(len(texts)), [len(s) for s, _ in cut])
                sums = np.array([tables.inside[t].sum() for t in texts])
                for at in range(0, len(slots), WINDOWS):
                    s, t = slots[at : at + WINDOWS], targets[at : at + WINDOWS]
                    logs = log_shares(w, attend(w, s, buffers).h, t.ravel(), buffers).reshape(t.shape)
                    logs[t < 0] = 0
                    sums += np.bincount(owner[at : at + WINDOWS], logs.sum(axis=1, dtype=float), len(texts)) / np.log(10)
                scores.append(sums)
            keep = [batch.column(c) for c in ("doc_id", "key", "digest", "train")]
            found = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays([*keep, found], ["doc_id", "key", "digest", "train", "score"])

    kind = dict(ids.dtypes)["doc_id"]
    return ids.mapInArrow(score, f"doc_id {kind}, key long, digest long, train boolean, score double")


def score_documents(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, folds: int = 7, held_out: int = 2, text: str = "text"
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
        (id_fold("doc_id", folds) != held_out).alias("train"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    counts = stored(word_counts(rows.filter("train")), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    base = base_scores(rows, counts, total, distinct)
    ids = stored(encoded(rows, ranks, pattern), "ids")
    tables = id_tables(ids, ranks)
    weights = flat(first_weights(tables.prior))
    for turn in range(ROUNDS):
        weights = train_round(ids, weights, tables.classes, turn)
    scored = model_scores(ids, weights, tables)
    return scored.join(base, ["key", "digest"], "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score",
    )
