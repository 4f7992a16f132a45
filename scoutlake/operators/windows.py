"""Per-entity series operators that survive one entity holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from scoutlake.functions.metrics import pct_change
from scoutlake.operators.ranges import range_sorted, stored_parts


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key under `order_by`.

    `row_number() = 1` plans as a group limit before and after the shuffle, so
    each map task sends one row per key, however many rows a key has.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") == 1).drop("_rn")


def first_in_ranges(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """`latest_per_key` in range partitions of the keys, sorted by them: one shuffle for both.

    Where some keys fill a range, a task sorts its rows and sends the first one of each key, so a key costs one row per map
    task here too. Bounds are sampled from the same plan, so such a sort runs twice and is left out elsewhere. The ranges hold whole keys, which is what the window asks for, so it adds no shuffle of its own.
    """
    placed = df.sortWithinPartitions(*keys, *order_by).mapInArrow(_new_keys(keys), df.schema) if _crowded(df, keys) else df
    return latest_per_key(placed.repartitionByRange(*keys), keys, order_by).sortWithinPartitions(*keys)


def _crowded(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether keys that share a hash bucket, with eight of them for each task, hold more rows than a task has on average."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(8 * parts)).alias("bucket")).agg(F.count("*").alias("n"))
    found = buckets.agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return bool(found.rows) and found.most * parts > found.rows


def _new_keys(keys: Sequence[str]):
    """Batches of one sorted partition without the rows whose keys equal those of the row before; nested to ship by value."""

    def new_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.array([False] * batch.num_rows)
            for i, key in enumerate(keys):
                column = batch.column(key)
                before = last[i] if last else pa.nulls(1, column.type)
                shifted = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
                same = pc.or_(pc.fill_null(pc.equal(column, shifted), False), pc.and_(column.is_null(), shifted.is_null()))
                new = pc.or_(new, pc.invert(same))
            if not last:
                new = pa.concat_arrays([pa.array([True]), new.slice(1)])
            last = [batch.column(key).slice(batch.num_rows - 1) for key in keys]
            yield batch.filter(new)

    return new_keys


def with_previous(
    df: DataFrame,
    entity: str,
    order_by: Sequence[str],
    value: str,
    alias: str = "prev_value",
    parts: int | None = None,
) -> DataFrame:
    """Value of the preceding row of the same entity, in `order_by` order.

    `order_by` starts with the time column and goes on with tie-breakers; the
    value itself breaks what is left, so the result is reproducible. Nulls come first,
    and rows without an entity form one history like any other. The columns must be atomic.

    Rows are dealt to `parts` ranges of (entity, order) and sorted, so that a history of any
    length is spread over tasks, one day of one entity included. Each task looks one row
    back; the first row of a range gets the last value of the range before, from a table of one row
    a range. The rows are stored in the shared folder once, and read from there.
    """
    kept = [c for c in df.columns if c != alias]
    order = list(dict.fromkeys([*order_by, value]))
    # Rows that are equal in the whole order are still told apart, so that no range has to hold them all.
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in plain))
    placed = range_sorted(df, [entity, *order, tie], parts)
    found = T.StructType([
        *placed.schema.fields, T.StructField("_prev", df.schema[value].dataType),
        T.StructField("_first", T.BooleanType()), T.StructField("_last", T.BooleanType()),
    ])
    rows = stored_parts(placed.mapInArrow(_one_back(entity, value), found), "previous")

    before = Window.orderBy("_part")
    ends = rows.filter("_last").select("_part", F.col(entity).alias("_end_entity"), F.col(value).alias("_end_value"))
    carried = ends.select(
        "_part", F.lag("_end_entity").over(before).alias("_end_entity"), F.lag("_end_value").over(before).alias("_end_value"),
        F.lit(True).alias("_first"), (F.row_number().over(before) > 1).alias("_follows"),
    )
    # One row per range, so it may be broadcast.
    linked = rows.join(F.broadcast(carried), ["_part", "_first"], "left")
    goes_on = F.col("_follows") & F.col(entity).eqNullSafe(F.col("_end_entity"))
    return linked.withColumn("_found", F.when(goes_on, F.col("_end_value")).otherwise(F.col("_prev"))).select(
        *kept, F.col("_found").alias(alias)
    )


def _one_back(entity: str, value: str):
    """Batches of one sorted partition with the value of the row before, and marks at both ends.

    The function is nested so that it ships by value: executors need no copy of this package.
    """

    def one_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None

        def marked(batch: pa.RecordBatch, previous: pa.Array, first: bool, final: bool) -> pa.RecordBatch:
            n = batch.num_rows
            starts, ends = [first] + [False] * (n - 1), [False] * (n - 1) + [final]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, previous, pa.array(starts), pa.array(ends)],
                [*batch.schema.names, "_prev", "_first", "_last"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            names, values = batch.column(entity), batch.column(value)
            first = last is None
            name_before, value_before = last or (pa.nulls(1, names.type), pa.nulls(1, values.type))
            shifted = pa.concat_arrays([name_before, names.slice(0, len(names) - 1)])
            back = pa.concat_arrays([value_before, values.slice(0, len(values) - 1)])
            same = pc.or_(pc.fill_null(pc.equal(names, shifted), False), pc.and_(names.is_null(), shifted.is_null()))
            if pa.types.is_floating(names.type):
                same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(names), pc.is_nan(shifted)), False))
            if first:
                same = pc.and_(same, pa.array([False] + [True] * (len(names) - 1)))
            if held:
                yield marked(*held, False)
            held = (batch, pc.if_else(same, back, pa.scalar(None, values.type)), first)
            last = names.slice(len(names) - 1), values.slice(len(values) - 1)
        if held:
            yield marked(*held, True)

    return one_back


def with_change(
    df: DataFrame,
    entity: str,
    order_by: Sequence[str],
    value: str,
    previous: str = "prev_value",
    change: str = "value_change_pct",
    digits: int | None = 2,
    parts: int | None = None,
) -> DataFrame:
    """Previous value and percent change per entity."""
    lagged = with_previous(df, entity, order_by, value, previous, parts)
    return lagged.withColumn(change, pct_change(value, previous, digits))
