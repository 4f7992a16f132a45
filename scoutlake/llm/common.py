"""What several operators share: stored tables, batch sizes, label folds and word ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scoutlake.session import work_dir

# Rows of an Arrow batch: with long texts a batch still fits into a Python worker.
BATCH_ROWS = 1_000
# Distinct words that a worker remembers before it starts anew; a cache only, never a limit.
MEMO_WORDS = 200_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage is cut, lost executors cost nothing."""
    path = work_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def wider(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of `df` with the columns of `ddl` behind it."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the rows per Arrow batch, if the session allows more than `BATCH_ROWS`."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def id_fold(column: str | Column, folds: int) -> Column:
    """Remainder of the CRC-32 of an id's decimal text; a null id counts as an empty text."""
    text = F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))
    return (F.crc32(text) % folds).cast("int")


def labelled(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label as int) of the rows that may be learned from, one per id; the larger label wins."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    learn = known.filter(id_fold("doc_id", folds) != held_out)
    return learn.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def bounded_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most `most` rows, chosen by a hash of the id: the same ones in every run."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered up to `MEMO_WORDS` words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def text_slices(batch, text: str = "text", rows: int = 64) -> Iterator[tuple[object, list[str]]]:
    """(slice of an Arrow batch, its texts with nulls as empty ones), some rows at a time."""
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        yield part, [t or "" for t in part.column(text).to_pylist()]
