"""Writers. All are distributed; Spark's commit protocol publishes a job's files together."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame

# Text is kept as it is, outer blanks and quotes included.
CSV_WRITE = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
# Fast gzip: a quarter more bytes than its default, for about no time.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
# Layers of text stand beside each other, so they are compressed. Such a file is one task, so it holds so many rows at most.
COMPRESSED = {**GZIP, "maxRecordsPerFile": 1_000_000}


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, nulls kept."""
    df.write.mode(mode).option("ignoreNullFields", False).options(**COMPRESSED).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_WRITE, **COMPRESSED).csv(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row."""
    df.write.mode(mode).options(**COMPRESSED).text(path)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> None:
    """`sort_by` orders rows inside each file, which makes the column statistics selective."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows in files of adjoining ranges of `by`, ordered inside: a filter on it opens few files, few row groups of them.

    Rows of one key may fill several files, as the range is of all columns. Adaptive execution sizes the files.
    """
    return df.repartitionByRange(*by).sortWithinPartitions(*by) if by else df


def new_stamp() -> str:
    """Ingestion time as the name of a history partition."""
    return f"{datetime.now(timezone.utc):%Y-%m-%dT%H-%M-%S-%f}"


def raw_folder(root: str, endpoint: str, stamp: str | None = None) -> str:
    """Folder of an endpoint, or of one of its ingestions."""
    return f"{root}/{endpoint}" + (f"/ingestion_ts={stamp}" if stamp else "")


def write_raw(
    df: DataFrame, root: str, endpoint: str, kind: str, keep_history: bool = False, stamp: str | None = None
) -> str:
    """Raw layer: a fixed folder that is replaced, or one partition per ingestion time (`stamp`, default now)."""
    target = raw_folder(root, endpoint, (stamp or new_stamp()) if keep_history else None)
    if kind == "csv":
        write_csv(df, target)
    elif kind == "text":
        write_text(df, target)
    else:
        write_json(df, target)
    return raw_folder(root, endpoint)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """Full refresh of a database table; `truncate` keeps its DDL."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, truncate="true", **options).save()
