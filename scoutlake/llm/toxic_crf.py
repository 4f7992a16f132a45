"""Toxic spans by a linear-chain conditional random field, aggregated to document scores.

The labels mark documents, the field needs marked words. Words and beginnings of
words that stand almost only in toxic documents, in more contexts than chance
explains, are chosen; words that merely share a copied text with an insult have
one context and are not. Chosen words of toxic documents are the labelled tokens.
The field has two states and features of the word, its beginnings, the word before
and the one behind it; it is fitted in numpy on windows of `WIDTH` words of a bounded
sample (`SAMPLE_TOXIC` and `SAMPLE_CLEAN` documents), which hold every chosen word of
its documents and one more place in each. If no unit has the evidence asked for,
those with the most are taken. Scoring reads every text to its end: forward-backward marginals of all
words, their largest one and their sum go into a logistic score.

Null and empty texts have no word and get the score of the absence of marginals.
Without a toxic document with a word to learn from, every score is 0. Other columns are kept;
repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import MEMO_WORDS, bounded_batches, bounded_sample, labelled, stored, text_slices, wider

SAMPLE_TOXIC, SAMPLE_CLEAN = 4_000, 8_000
PRECISION, CERTAINTY = 0.9, 2.0
BEGINNINGS = (4, 5)
WIDTH = 32
# Neighbours have few buckets, so that the field cannot learn single contexts by heart.
BUCKETS, NEAR = 1 << 16, 64
STEPS, RATE, PENALTY = 60, 0.5, 1e-3
CHUNK = 64
FLOOR, CEILING = -12.0, 12.0
WORD = re.compile(r"\w+")


class Model(NamedTuple):
    """Weights of a word's units, of the word before and the one behind; log transitions; logistic weights."""

    units: np.ndarray
    before: np.ndarray
    behind: np.ndarray
    moves: np.ndarray
    logistic: np.ndarray


class Beginnings(dict):
    """First characters of a word in lower case -> buckets of its beginnings, packed."""

    def __missing__(self, head: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = 0
        for at, unit in enumerate(units(head)[1:], 1):
            found |= (1 + crc32(unit.encode()) % (BUCKETS - 1)) << 16 * at
        self[head] = found
        return found


class Buckets(dict):
    """Word -> buckets of its units (the word in lower case and its two beginnings), packed into one number.

    Bucket 0 stands for the edge of a text and for a beginning that a short word does not have.
    """

    def __init__(self):
        super().__init__()
        self.beginnings = Beginnings()

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        word_low = word.lower()
        found = self[word] = self.beginnings[word_low[: BEGINNINGS[-1]]] | 1 + crc32(word_low.encode()) % (BUCKETS - 1)
        return found

    def of(self, text: str) -> np.ndarray:
        found = WORD.findall(text)
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


class Marks(dict):
    """Word -> whether one of its units is among the chosen ones."""

    def __init__(self, chosen: frozenset[str]):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: str) -> bool:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = not self.chosen.isdisjoint(units(word.lower()))
        return found


def units(word: str) -> list[str]:
    """The word, and its first four and five characters as beginnings."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) >= n)]


def unpacked(ids: np.ndarray) -> list[np.ndarray]:
    return [(ids >> 16 * at) & 0xFFFF for at in range(1 + len(BEGINNINGS))]


def emissions(ids: np.ndarray, model: Model) -> np.ndarray:
    """Log weight of the toxic state against the other one, for the words of one text."""
    edged = np.concatenate([[0], ids, [0]]) & 0xFFFF
    own = sum(model.units[u] for u in unpacked(ids))
    return np.clip(own + model.before[edged[:-2] % NEAR] + model.behind[edged[2:] % NEAR], FLOOR, CEILING)


def marginals(scores: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Probability of the toxic state for every word of every text.

    Texts are cut into runs of `CHUNK` words. Products of the 2 x 2 step matrices
    are taken for all runs at once; states then pass from run to run of a text.
    """
    lengths = np.array([len(s) for s in scores])
    runs = -(-lengths // CHUNK)
    first = np.concatenate([[0], np.cumsum(runs)])
    total = int(first[-1])
    if not total:
        return [np.zeros(0) for _ in scores]
    weight = np.zeros(total * CHUNK)
    real = np.zeros(total * CHUNK, bool)
    for s, at in zip(scores, first * CHUNK):
        weight[at : at + len(s)], real[at : at + len(s)] = s, True
    weight, real = np.exp(weight).reshape(total, CHUNK).T, real.reshape(total, CHUNK).T
    a = np.exp(moves)

    def step(i: int) -> np.ndarray:
        m = np.empty((2, 2, total))
        m[0, 0], m[1, 0] = a[0, 0], a[1, 0]
        m[0, 1], m[1, 1] = a[0, 1] * weight[i], a[1, 1] * weight[i]
        return np.where(real[i], m, np.eye(2)[:, :, None])

    def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.stack([
            np.stack([x[0, 0] * y[0, 0] + x[0, 1] * y[1, 0], x[0, 0] * y[0, 1] + x[0, 1] * y[1, 1]]),
            np.stack([x[1, 0] * y[0, 0] + x[1, 1] * y[1, 0], x[1, 0] * y[0, 1] + x[1, 1] * y[1, 1]]),
        ])
        return z / z.sum(axis=(0, 1))

    unit = np.repeat(np.eye(2)[:, :, None], total, axis=2)
    steps = [step(i) for i in range(CHUNK)]
    prefix, suffix = [times(unit, steps[0])], [unit]
    for i in range(1, CHUNK):
        prefix.append(times(prefix[-1], steps[i]))
    for i in range(CHUNK - 1, 0, -1):
        suffix.append(times(steps[i], suffix[-1]))
    suffix.reverse()
    whole = prefix[-1]

    start, end = np.empty((2, total)), np.empty((2, total))
    state, back = np.tile([[1.0], [0.0]], len(scores)), np.ones((2, len(scores)))
    for j in range(int(runs.max())):
        texts = np.flatnonzero(runs > j)
        at = first[texts] + j
        start[:, at] = now = state[:, texts]
        state[:, texts] = now[0] * whole[0][:, at] + now[1] * whole[1][:, at]
        state[:, texts] /= state[:, texts].sum(axis=0)
        at = first[texts] + runs[texts] - 1 - j
        end[:, at] = now = back[:, texts]
        back[:, texts] = whole[:, 0][:, at] * now[0] + whole[:, 1][:, at] * now[1]
        back[:, texts] /= back[:, texts].sum(axis=0)

    toxic = np.empty((CHUNK, total))
    for i in range(CHUNK):
        ahead = start[0] * prefix[i][0] + start[1] * prefix[i][1]
        behind = suffix[i][:, 0] * end[0] + suffix[i][:, 1] * end[1]
        both = ahead * behind
        toxic[i] = both[1] / both.sum(axis=0)
    flat = toxic.T.reshape(-1)
    return [flat[at : at + n] for at, n in zip(first * CHUNK, lengths)]


def train_field(windows: np.ndarray, marked: np.ndarray, steps: int = STEPS) -> Model:
    """Fits the field by adaptive gradient steps; windows (n, WIDTH + 2) of buckets, -1 behind the end."""
    inner, real = windows[:, 1:-1], windows[:, 1:-1] >= 0
    groups = [np.where(real, u, 0) for u in unpacked(np.maximum(inner, 0))]
    near = np.maximum(windows, 0) & 0xFFFF
    groups += [np.where(real, x % NEAR, 0) for x in (near[:, :-2], near[:, 2:])]
    # The units share one table; neighbours have one each.
    tables = [0, 0, 0, 1, 2]
    y = (marked & real).astype(float)
    weights = [np.zeros(BUCKETS) for _ in range(3)]
    moves = np.log(np.array([[0.98, 0.02], [0.7, 0.3]]))
    seen = [np.full(BUCKETS, 1e-6) for _ in weights]
    moved = np.full((2, 2), 1e-6)
    n, width = inner.shape
    before = np.concatenate([np.zeros((n, 1)), y[:, :-1]], axis=1)
    for _ in range(steps):
        score = np.clip(sum(weights[t][g] for t, g in zip(tables, groups)), FLOOR, CEILING)
        e, a = np.exp(score), np.exp(moves)
        ahead = np.empty((width, 2, n))
        state = np.stack([np.ones(n), np.zeros(n)])
        for i in range(width):
            nxt = np.stack([state[0] * a[0, 0] + state[1] * a[1, 0], (state[0] * a[0, 1] + state[1] * a[1, 1]) * e[:, i]])
            state = np.where(real[:, i], nxt / nxt.sum(axis=0), state)
            ahead[i] = state
        back, expected, tox = np.ones((2, n)), np.zeros((2, 2)), np.empty((n, width))
        for i in range(width - 1, -1, -1):
            both = ahead[i] * back
            tox[:, i] = both[1] / both.sum(axis=0)
            earlier = ahead[i - 1] if i else np.stack([np.ones(n), np.zeros(n)])
            joint = earlier[:, None] * a[:, :, None] * np.stack([back[0], back[1] * e[:, i]])[None]
            joint /= joint.sum(axis=(0, 1))
            expected += (joint * real[:, i]).sum(axis=2)
            prev = np.stack([a[0, 0] * back[0] + a[0, 1] * e[:, i] * back[1], a[1, 0] * back[0] + a[1, 1] * e[:, i] * back[1]])
            back = np.where(real[:, i], prev / prev.sum(axis=0), back)
        miss = np.where(real, y - tox, 0.0).ravel()
        for k, (w, s) in enumerate(zip(weights, seen)):
            slope = sum(np.bincount(g.ravel(), miss, BUCKETS) for t, g in zip(tables, groups) if t == k)
            slope -= PENALTY * n * 0.01 * w
            slope[0] = 0.0
            s += slope**2
            w += RATE * slope / np.sqrt(s)
        found = np.array([[((before == i) & (y == j) & real).sum() for j in (0, 1)] for i in (0, 1)], float)
        slope = found - expected
        moved += slope**2
        moves = moves + 0.1 * slope / np.sqrt(moved)
    kept = [w.astype(np.float32) for w in weights]
    return Model(*kept, moves, np.zeros(3))


def document_features(p: list[np.ndarray]) -> np.ndarray:
    """(texts, 2): logit of the largest marginal and log of the expected number of toxic words."""
    peak = np.array([x.max(initial=0.0) for x in p])
    logit = np.clip(np.log(np.maximum(peak, 1e-9) / np.maximum(1 - peak, 1e-9)), FLOOR, CEILING)
    return np.stack([logit, np.log1p([x.sum() for x in p])], axis=1)


def train_logistic(x: np.ndarray, y: np.ndarray, steps: int = 400) -> np.ndarray:
    """Logistic weights (bias first) by Newton steps with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(design.shape[1])
    for _ in range(min(steps, 30)):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(len(w))
        w += np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 0.1 * w), -2, 2)
    return w


def _sampled(docs: DataFrame, learn: DataFrame, text: str) -> DataFrame:
    """(label, text) of the bounded sample, one row per distinct text."""
    toxic = bounded_sample(learn.filter("label = 1"), SAMPLE_TOXIC)
    clean = bounded_sample(learn.filter("label = 0"), SAMPLE_CLEAN)
    # The sample has at most SAMPLE_TOXIC + SAMPLE_CLEAN rows, so it may be broadcast.
    joined = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(toxic.unionAll(clean)), "doc_id")
    return joined.groupBy("text").agg(F.max("label").alias("label"))


def _contexts(sample: DataFrame) -> DataFrame:
    """(label, word, before): the distinct words of each text with the word before, in lower case."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, rows=16):
                labels, words, before = [], [], []
                for text, label in zip(texts, part.column("label").to_pylist()):
                    found = [w.lower() for w in WORD.findall(text)]
                    pairs = set(zip(found, ["", *found]))
                    labels += [label] * len(pairs)
                    words += [w for w, _ in pairs]
                    before += [b for _, b in pairs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels, pa.int32()), pa.array(words, pa.string()), pa.array(before, pa.string())],
                    ["label", "word", "before"],
                )

    return sample.select("label", "text").mapInArrow(cut, "label int, word string, before string")


def chosen_units(sample: DataFrame) -> list[str]:
    """The units (words and beginnings of words) that mark toxic documents of the sample.

    A unit is taken if it stands behind so many different words, nearly always
    in toxic documents, that chance is no reason among all units there are.
    Words of a copied text always stand behind the same word and are not taken.
    """
    totals = sample.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not totals[0]:
        return []
    toxic, clean = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    behind = _contexts(sample).groupBy("word", "before").agg(toxic.alias("t"), clean.alias("c"))
    starts = [F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in BEGINNINGS]
    each = behind.select("t", "c", F.explode(F.array_compact(F.array("word", *starts))).alias("unit"))
    counted = stored(
        each.groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(F.col("t") > 0).alias("contexts")),
        "toxic-units",
    )
    # Rates, so that the mix of the sample does not matter.
    rate, other = F.col("t") / float(totals[0]), F.col("c") / float(max(totals[1], 1))
    share = totals[0] / (totals[0] + max(totals[1], 1))
    needed = CERTAINTY * float(np.log(counted.count() + 1) / np.log(1 / share))
    # Either the demands, or what comes closest to them. The units of a sample are bounded like its texts.
    held = counted.filter("contexts > 0").withColumn("p", F.least(rate / (rate + other), F.lit(PRECISION)))
    best = held.agg(F.max(F.struct("p", F.least("contexts", F.lit(needed)).alias("e"))).alias("m")).first().m
    if best is None:
        return []
    return sorted(r.unit for r in held.filter((F.col("p") >= best.p) & (F.col("contexts") >= best.e)).select("unit").collect())


def _windows(sample: DataFrame, lexicon: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of packed buckets and their marks: around chosen words, and one anywhere in every document."""
    chosen = frozenset(lexicon)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, marks = Buckets(), Marks(chosen)
        for batch in batches:
            for part, texts in text_slices(batch, rows=8):
                rows, flags = [], []
                for text, label in zip(texts, part.column("label").to_pylist()):
                    words = WORD.findall(text)
                    if not words:
                        continue
                    ids = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
                    hit = np.fromiter(map(marks.__getitem__, words), bool, len(words))
                    starts = [xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) % len(ids)]
                    # Every chosen word is in a window, in the middle of one if it stands alone.
                    end = 0
                    for i in np.flatnonzero(hit).tolist():
                        if i >= end:
                            starts.append(max(0, i - WIDTH // 2))
                            end = starts[-1] + WIDTH
                    for at in starts:
                        window = np.full(WIDTH + 2, -1, np.int64)
                        window[0] = ids[at - 1] if at else 0
                        taken = ids[at : at + WIDTH + 1]
                        window[1 : 1 + len(taken)] = taken
                        if 1 + len(taken) < WIDTH + 2:
                            window[-1] = 0
                        mark = np.zeros(WIDTH, bool)
                        mark[: len(taken[:WIDTH])] = hit[at : at + WIDTH] & bool(label)
                        rows.append(window)
                        flags.append(mark)
                if rows:
                    lists = [
                        pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(x[0]), pa.array(np.concatenate(x)))
                        for x in (rows, flags)
                    ]
                    yield pa.RecordBatch.from_arrays(lists, ["ids", "marks"])

    found = sample.mapInArrow(cut, "ids array<long>, marks array<boolean>").toArrow()
    if not found.num_rows:
        return np.zeros((0, WIDTH + 2), np.int64), np.zeros((0, WIDTH), bool)
    ids = found.column("ids").combine_chunks().flatten().to_numpy().reshape(-1, WIDTH + 2)
    flags = found.column("marks").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
    order = np.lexsort(ids.T)
    return ids[order], flags[order]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, text: str = "text") -> Model | None:
    """The field and its logistic weights, from labels outside the held-out fold; None without toxic documents."""
    bounded_batches(docs.sparkSession)
    sample = stored(_sampled(docs, labelled(labels, "toxic", folds, held_out), text), "toxic-sample")
    lexicon = chosen_units(sample)
    if not lexicon:
        return None
    windows, marked = _windows(sample, lexicon)
    model = train_field(windows, marked)
    rows = spans(sample, model).select("label", "peak", "mass").toArrow().to_pandas()
    rows = rows.sort_values(["label", "peak", "mass"])
    logistic = train_logistic(rows[["peak", "mass"]].to_numpy(), rows["label"].to_numpy(float))
    return model._replace(logistic=logistic)


def spans(docs: DataFrame, model: Model, text: str = "text", cut: float = 0.5) -> DataFrame:
    """`docs` with peak, mass (document features) and spans: offsets [start, end) of offending words."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, buckets = Model(*shared.value), Buckets()
        for batch in batches:
            for part, texts in text_slices(batch, text, 128):
                p = marginals([emissions(buckets.of(t), model) for t in texts], model.moves)
                offsets = []
                for t, x in zip(texts, p):
                    hit = np.flatnonzero(x >= cut).tolist()
                    places = [m.span() for m in WORD.finditer(t)] if hit else []
                    offsets.append([{"start": places[i][0], "end": places[i][1]} for i in hit])
                features = document_features(p)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(features[:, 0]), pa.array(features[:, 1]), pa.array(offsets, kind)],
                    [*part.schema.names, "peak", "mass", "spans"],
                )

    docs = docs.drop("peak", "mass", "spans")
    return docs.mapInArrow(
        tag, wider(docs, "peak double, mass double, spans array<struct<start: int, end: int>>")
    )


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """`docs` with score, predicted and spans."""
    if model is None:
        empty = F.array().cast("array<struct<start: int, end: int>>")
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "spans": empty})
    bias, peak, mass = (float(w) for w in model.logistic)
    logit = F.lit(bias) + F.lit(peak) * F.col("peak") + F.lit(mass) * F.col("mass")
    scored = spans(docs, model, text).withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("peak", "mass")
