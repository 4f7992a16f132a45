"""Global positions without a single task: range partitions, and one row per partition to link them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scoutlake.session import work_dir

_ROWS = (1 << 33) - 1


def range_sorted(df: DataFrame, order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """`df` in range partitions of `order`, each sorted, with the number of the partition as `_part`."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return placed.withColumn("_part", F.spark_partition_id())


def stored_parts(placed: DataFrame, name: str) -> DataFrame:
    """Rows with a `_part`, written to the shared folder and read back: a lost executor cannot deal them anew."""
    path = work_dir(placed.sparkSession, name)
    placed.write.parquet(path)
    return placed.sparkSession.read.schema(placed.schema).parquet(path)


def ranked(df: DataFrame, order: Sequence[Column | str], alias: str = "rank") -> DataFrame:
    """`df` with the 0-based position of each row in `order`, which should be unique.

    Rows are range-partitioned, sorted and numbered inside their partition; the
    only table that one task sees whole has one row per partition. The numbered
    rows are stored in the shared folder, so a lost executor cannot renumber them.
    """
    # The lower 33 bits count the rows of a partition in their order.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS))
    rows = stored_parts(range_sorted(df, order).withColumn("_row", row), "ranked")
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per partition: as many as the shuffle has tasks, so it may be broadcast.
    placed = rows.join(F.broadcast(offsets), "_part")
    return placed.withColumn(alias, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def middle_values(counted: DataFrame, value: str, count: str) -> DataFrame:
    """One row (low, high): the values at the lower and upper middle rank; null without values.

    `counted` has each value once, with how often it occurs. Cumulative counts of the
    range partitions, one row each, tell which one or two of them hold the
    middle ranks, and only the rows of those are counted through.
    """
    rows = stored_parts(range_sorted(counted.select(F.col(value).alias("_value"), F.col(count).alias("_count")), ["_value"]), "values")
    sums = rows.groupBy("_part").agg(F.sum("_count").alias("_sum"))
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sums.select("_part", "_sum", F.sum("_sum").over(so_far).alias("_end"), F.sum("_sum").over(whole).alias("_all"))
    low, high = F.call_function("div", F.col("_all") + 1, F.lit(2)), F.call_function("div", F.col("_all"), F.lit(2)) + 1
    middle = ends.select(
        "_part", (F.col("_end") - F.col("_sum")).alias("_before"), F.col("_end"), low.alias("_low"), high.alias("_high")
    ).filter((F.col("_before") < F.col("_high")) & (F.col("_end") >= F.col("_low")))
    inside = Window.partitionBy("_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most two of the parts are left.
    near = rows.join(F.broadcast(middle), "_part").withColumn("_upto", F.col("_before") + F.sum("_count").over(inside))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_upto") >= F.col(rank)) & (F.col("_upto") - F.col("_count") < F.col(rank)), F.col("_value")))

    return near.agg(at("_low").alias("low"), at("_high").alias("high"))
