"""Scans. Schemas are explicit; paths may be local or on an object store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# The null text is one that no file holds: nothing without quotes is null, quoted nothing is an empty text.
CSV_READ = {"header": True, "escape": '"', "nullValue": "\x00"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    min_partitions: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header, gzipped or not; columns are matched to the header by name.

    Text that does not fit its type becomes null. A gzipped file is one task, so
    `min_partitions` spreads the rows right after the scan. `multi_line` reads
    line breaks inside quotes; a file is one task then.
    """
    # Every file's header is checked against the first one's, so columns cannot be mixed up silently.
    reader = spark.read.options(**CSV_READ, enforceSchema=False, multiLine=multi_line)
    names = reader.csv(path).columns
    texts = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(path)
    if min_partitions:
        texts = texts.repartition(min_partitions)
    if schema is None:
        return texts
    wanted = [f for f in schema if f.name in names]
    return texts.select(*(_parsed(f).alias(f.name) for f in wanted))


def _parsed(field: T.StructField):
    """Integers may be written with a fraction ("12.0")."""
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return F.coalesce(text.try_cast(field.dataType), text.try_cast("double").try_cast(field.dataType))
    return text if isinstance(field.dataType, T.StringType) else text.try_cast(field.dataType)


def read_wrapped_json(
    spark: SparkSession, path: str | list[str], array_field: str, item: T.StructType, multiline: bool = True
) -> DataFrame:
    """One row per item of `array_field`, as a struct column `item`.

    Both layouts are read: an object that holds the array, and a bare root array,
    which the scan delivers as one row per element. Large inputs should be landed
    as JSON lines and read with `multiline=False`, because one multi-line
    document is one task.
    """
    rows = spark.read.schema(T.StructType([T.StructField(array_field, T.ArrayType(item)), *item.fields]))
    rows = rows.option("multiLine", multiline).json(path)
    bare = F.struct(*item.fieldNames())
    is_bare = F.coalesce(*(F.col(f"`{c}`").isNotNull() | F.lit(None) for c in item.fieldNames()), F.lit(False))
    items = F.when(F.col(array_field).isNotNull(), F.col(array_field)).when(is_bare, F.array(bare))
    return rows.select(F.explode(items).alias("item"))


def read_payloads(
    spark: SparkSession, path: str | list[str], array_field: str | None, json_lines: bool = False
) -> DataFrame:
    """Raw JSON text of every payload item (`payload`) with the file it came from (`source_file`).

    A directory of per-league files is one scan, which is the union of their arrays. A file
    is one document, or one document per line with `json_lines`, which can be split.
    """
    source = F.col("_metadata.file_path").alias("source_file")
    if array_field is None:
        whole = spark.read.text(path, wholetext=not json_lines)
        return whole.select(F.col("value").alias("payload"), source)
    texts = T.StructType([T.StructField(array_field, T.ArrayType(T.StringType()))])
    rows = spark.read.schema(texts).option("multiLine", not json_lines).json(path)
    return rows.select(F.explode(array_field).alias("payload"), source)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_jdbc(spark: SparkSession, url: str, query: str, properties: Mapping[str, str] | None = None) -> DataFrame:
    """A query on a database, where gold is served from one; the driver jar is the cluster's."""
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load()


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
