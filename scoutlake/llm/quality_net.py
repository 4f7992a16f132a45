"""Document quality: random-indexing word vectors, pooled, and a small calibrated network.

A text is a stream of slots: each white-space token gives the slot of its word
(letters and digits in lower case) and the slot of its form (letter case and outer
punctuation). Words are hashed to `WORDS` slots and forms to `FORMS`, so every table
has a fixed size whatever the vocabulary. A slot's context vector is the sum of the
sparse random index vectors of the slots up to `REACH` places away, over the whole
corpus; the sums are whole numbers, so they do not depend on the order of the tasks.
Documents pool the normalised vectors of their words and forms. A two-layer network
in numpy learns from at most `SAMPLE` labelled documents; a fifth of them sets the
temperature that calibrates its probabilities.

Null and empty texts pool to zeros and are scored like any other. With no label to
learn from, every score is 0.5. Repeated rows are scored alike, other columns kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import MEMO_WORDS, bounded_batches, bounded_sample, labelled, text_slices, wider

WORDS, FORMS, DIMS, ENTRIES, REACH = 8_192, 1_024, 32, 4, 3
SLOTS = WORDS + FORMS
SAMPLE = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 128, 3e-3, 1e-4
SEED = 7
_EDGE = re.compile(r"^(\W*)(.*?)(\W*)$", re.DOTALL)


class Network(NamedTuple):
    """Slot vectors, scaling of the inputs, two layers and a temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float


class Slots(dict):
    """Token -> word slot and form slot in one number."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        before, core, after = _EDGE.match(token).groups()
        case = "u" if core.isupper() else "t" if core[:1].isupper() else "l" if core.islower() else "o"
        word = xxhash.xxh64_intdigest(core.lower().encode("utf-8", "surrogatepass")) % WORDS
        form = xxhash.xxh64_intdigest(f"{before[:4]} {case} {after[:4]}".encode("utf-8", "surrogatepass")) % FORMS
        found = self[token] = word * FORMS + form
        return found

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        tokens = text.split()
        both = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return both // FORMS, WORDS + both % FORMS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(slots, ENTRIES) places and signs of the sparse index vectors."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMS, (SLOTS, ENTRIES)), rng.choice([-1.0, 1.0], (SLOTS, ENTRIES))


def corpus_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(SLOTS, DIMS) unit context vectors, summed over every document."""
    bounded_batches(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, (places, signs) = Slots(), index_vectors()
        sums = np.zeros(SLOTS * DIMS)
        for batch in batches:
            for _, texts in text_slices(batch, text, 256):
                streams = [np.stack(slots.of(t), axis=1).ravel() for t in texts]
                stream = np.concatenate(streams)
                owner = np.repeat(np.arange(len(streams)), [len(s) for s in streams])
                for gap in range(1, REACH + 1):
                    same = owner[gap:] == owner[:-gap]
                    a, b = stream[:-gap][same], stream[gap:][same]
                    for x, y in ((a, b), (b, a)):
                        for k in range(ENTRIES):
                            sums += np.bincount(x * DIMS + places[y, k], signs[y, k], SLOTS * DIMS)
        rows = sums.reshape(SLOTS, DIMS).astype(np.int64)
        seen = np.flatnonzero(rows.any(axis=1))
        if len(seen):
            values = pa.ListArray.from_arrays(
                pa.array(np.arange(len(seen) + 1, dtype=np.int32) * DIMS), pa.array(rows[seen].ravel())
            )
            yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), values], ["slot", "v"])

    parts = docs.select(text).mapInArrow(gather, "slot int, v array<long>")
    total = parts.groupBy("slot").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIMS)))
    # SLOTS rows at most.
    found = total.toArrow().to_pandas()
    vectors = np.zeros((SLOTS, DIMS))
    vectors[found["slot"]] = found[[f"v{i}" for i in range(DIMS)]].to_numpy(float)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str, slots: Slots, vectors: np.ndarray) -> np.ndarray:
    """Means and spread of the word vectors, mean of the form vectors, and how far words repeat."""
    words, forms = slots.of(text)
    n = len(words)
    if not n:
        return np.zeros(3 * DIMS + 3, np.float32)
    w, f = vectors[words], vectors[forms]
    mean = w.mean(axis=0)
    plain = [np.log1p(n), len(np.unique(words)) / n, len(np.unique(forms)) / n]
    return np.concatenate([mean, w.std(axis=0), f.mean(axis=0), plain]).astype(np.float32)


def train_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray) -> Network:
    """Adam on the log loss; every fifth row is kept for the temperature."""
    rng = np.random.default_rng(SEED)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.clip((x - centre) / scale, -6, 6)
    calibrate = np.arange(len(z)) % 5 == 4
    if len(z) < 50:
        calibrate[:] = False
    a, b = z[~calibrate], y[~calibrate]
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(EPOCHS if len(a) > 2_000 else 2 * EPOCHS):
        order = rng.permutation(len(a))
        for at in range(0, len(a), BATCH):
            rows = order[at : at + BATCH]
            h = np.maximum(a[rows] @ params[0] + params[1], 0)
            miss = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - b[rows]) / len(rows)
            inner = np.outer(miss, params[2]) * (h > 0)
            slopes = [a[rows].T @ inner + DECAY * params[0], inner.sum(axis=0), h.T @ miss + DECAY * params[2], np.array([miss.sum()])]
            step += 1
            for p, m, v, g in zip(params, first, second, slopes):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w1, b1, w2, b2 = params
    c, t = (z[calibrate], y[calibrate]) if calibrate.any() else (z, y)
    logits = np.maximum(c @ w1 + b1, 0) @ w2 + b2[0]

    def loss(heat: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / heat) - t * logits / heat))

    best = min(np.geomspace(0.5, 10, 80), key=loss)
    return Network(vectors, centre, scale, w1, b1, w2, float(b2[0]), float(best))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, text: str = "text") -> Network | None:
    """Vectors of the whole corpus, and the network from labels outside the held-out fold."""
    bounded_batches(docs.sparkSession)
    vectors = corpus_vectors(docs, text)
    learn = bounded_sample(labelled(labels, "quality", folds, held_out), SAMPLE)
    # At most SAMPLE rows, so the sample may be broadcast, and its features fit the driver.
    rows = docs.select("doc_id", F.col(text).alias("text")).join(F.broadcast(learn), "doc_id")
    found = _featured(rows, vectors, "text").select("doc_id", "label", "features").toArrow()
    if not found.num_rows:
        return None
    x = np.array(found.column("features").to_pylist(), np.float32)
    ids, y = found.column("doc_id").to_numpy(), found.column("label").to_numpy().astype(float)
    # Order by a hash of the id, so that neither training nor calibration depends on the task order.
    keys = np.array([xxhash.xxh64_intdigest(str(i)) for i in ids], np.uint64)
    order = np.lexsort((x[:, 0], keys))
    return train_network(x[order].astype(float), y[order], vectors)


def _featured(docs: DataFrame, vectors: np.ndarray, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, vectors = Slots(), shared.value
        for batch in batches:
            for part, texts in text_slices(batch, text):
                rows = [pooled(t, slots, vectors) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rows, pa.list_(pa.float32()))], [*part.schema.names, "features"]
                )

    return docs.mapInArrow(features, wider(docs, "features array<float>"))


def score_documents(docs: DataFrame, network: Network | None, text: str = "text") -> DataFrame:
    """`docs` with score and predicted."""
    bounded_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    if network is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(tuple(network))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, net = Slots(), Network(*shared.value)
        for batch in batches:
            for part, texts in text_slices(batch, text):
                z = np.clip((np.stack([pooled(t, slots, net.vectors) for t in texts]) - net.centre) / net.scale, -6, 6)
                logit = (np.maximum(z @ net.w1 + net.b1, 0) @ net.w2 + net.b2) / net.temperature
                p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p.astype(float))], [*part.schema.names, "score"])

    scored = docs.mapInArrow(score, wider(docs, "score double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
