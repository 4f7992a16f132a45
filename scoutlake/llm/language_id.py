"""Language of documents: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; each run of other characters than letters becomes one border,
and so do both ends. Every sequence of 1 to `LONGEST` characters and borders is hashed
to one of `SLOTS` slots, so the tables have a fixed size whatever the scripts. The
counts of each language are summed over all documents that may be learned from. The
matrix of smoothed log-probabilities is broadcast, and texts are scored by the batch: the slots of
the texts, one after another with an offset for each text, are the rows of a sparse
matrix, whose product with the log-probabilities is a gather and a segmented sum.

A text that is null or has no letter, and any text where nothing could be learned,
gives `und` with score 0; rows without a language are scored but not learned from. Of
languages with equal scores the first by name wins. Repeated rows count as often as
they occur and are scored alike. Columns named like an added one are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from scoutlake.llm.common import bounded_batches, id_fold, text_slices, wider

SLOTS, LONGEST, SMOOTHING = 1 << 15, 3, 0.5
# Slots of a row of counts; characters that a task holds as numbers at once.
WIDTH, PIECE = 64, 1 << 18
# The matrix has SLOTS numbers for each language: 256 MB at the most.
MOST_LANGUAGES = 1_024
UNKNOWN = "und"


class Model(NamedTuple):
    """Languages in order of name, log-probabilities (language, slot) and log-shares of the documents."""

    languages: list[str]
    logs: np.ndarray
    priors: np.ndarray


def letter_bits() -> np.ndarray:
    """One bit for each code point: whether it is a letter."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))


class Grams:
    """Slots of the n-grams of texts."""

    def __init__(self, bits: np.ndarray):
        self.letters = np.unpackbits(bits).astype(bool)

    def stream(self, text: str) -> np.ndarray:
        """Letters as numbers, with one 0 for each border; empty if there is no letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = self.letters[codes]
        if not is_letter.any():
            return np.zeros(0, np.uint32)
        codes = np.append(np.where(is_letter, codes, 0), 0).astype(np.uint32)
        kept = codes != 0
        kept[1:] |= codes[:-1] != 0
        return np.concatenate((np.zeros(1, np.uint32), codes[kept]))

    def slots(self, text: str) -> Iterator[np.ndarray]:
        """The slots, in pieces of bounded size that together hold each n-gram once."""
        codes = self.stream(text)
        for at in range(0, len(codes), PIECE):
            piece, n = codes[at : at + PIECE + LONGEST - 1], min(PIECE, len(codes) - at)
            found, mixed = [], np.zeros(len(piece), np.uint32)
            for size in range(1, LONGEST + 1):
                # Sequences that begin among the first n characters and end inside the text.
                ends = len(piece) - size + 1
                mixed = mixed[:ends] * np.uint32(2_654_435_761) + piece[size - 1 :] + np.uint32(size)
                spread = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(2_246_822_519)
                found.append(spread[:n] >> np.uint32(32 - 15))
            yield np.concatenate(found)


def fit(
    docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", folds: int = 4, held_out: int = 2
) -> Model | None:
    """The model of all rows with a language outside the held-out fold; None if there is none."""
    spark = docs.sparkSession
    bounded_batches(spark)
    learn = docs.filter(F.col(label).isNotNull() & (id_fold(key, folds) != held_out))
    learn = learn.select(F.col(text).alias("text"), F.col(label).cast("string").alias("label"))
    known = {r.label: r.n for r in learn.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if not known:
        return None
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: the column holds something else")
    languages = sorted(known)
    shared = spark.sparkContext.broadcast((languages, letter_bits()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bits = shared.value
        place, grams, sums = {name: i for i, name in enumerate(names)}, Grams(bits), {}
        for batch in batches:
            for part, texts in text_slices(batch, "text"):
                for name, body in zip(part.column("label").to_pylist(), texts):
                    for slots in grams.slots(body):
                        if name not in sums:
                            sums[name] = np.zeros(SLOTS, np.int64)
                        # A text has few slots beside the whole table.
                        if len(slots) < SLOTS // 8:
                            np.add.at(sums[name], slots, 1)
                        else:
                            sums[name] += np.bincount(slots, minlength=SLOTS)
        for name, counted in sums.items():
            rows = counted.reshape(-1, WIDTH)
            seen = np.flatnonzero(rows.any(axis=1))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(seen) + 1, dtype=np.int32) * WIDTH), pa.array(rows[seen].ravel()))
            at = pa.array(np.full(len(seen), place[name], np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(seen.astype(np.int32)), values], ["language", "row", "v"])

    parts = learn.mapInArrow(gather, "language int, row int, v array<long>")
    total = parts.groupBy("language", "row").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(WIDTH)))
    # At most SLOTS / WIDTH rows for each language.
    found = total.toArrow().to_pandas()
    counts = np.zeros((len(languages), SLOTS // WIDTH, WIDTH))
    counts[found["language"], found["row"]] = found[[f"v{i}" for i in range(WIDTH)]].to_numpy(float)
    counts = counts.reshape(len(languages), SLOTS) + SMOOTHING
    documents = np.array([known[name] for name in languages], float)
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)), np.log(documents / documents.sum()))


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`docs` with lang_pred and score, the probability that the model gives to that language."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = spark.sparkContext.broadcast((tuple(model), letter_bits()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields, bits = shared.value
        model, grams = Model(*fields), Grams(bits)

        def sums(pieces: list[np.ndarray]) -> np.ndarray:
            """(pieces, languages) log-probabilities: the sparse product."""
            flat = np.concatenate(pieces)
            starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces])[:-1]))
            return np.stack([np.add.reduceat(logs[flat], starts) for logs in model.logs], axis=1)

        for batch in batches:
            for part, texts in text_slices(batch, text):
                evidence, known = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), bool)
                owners, pieces, held = [], [], 0
                for row, body in enumerate(texts):
                    for slots in grams.slots(body):
                        known[row] = True
                        owners.append(row)
                        pieces.append(slots)
                        held += len(slots)
                        if held > PIECE:
                            np.add.at(evidence, owners, sums(pieces))
                            owners, pieces, held = [], [], 0
                if pieces:
                    np.add.at(evidence, owners, sums(pieces))
                evidence += model.priors
                best = evidence.argmax(axis=1)
                odds = np.exp(evidence - evidence.max(axis=1, keepdims=True))
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                scores = np.where(known, 1 / odds.sum(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(scores)],
                    [*part.schema.names, "lang_pred", "score"],
                )

    return docs.mapInArrow(score, wider(docs, "lang_pred string, score double"))
