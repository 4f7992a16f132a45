"""Projections, filters, joins, top-k and ad-hoc access."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from scoutlake.operators.query_text import run_query_text


def select_existing(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """The listed columns that exist, in list order; `strict` makes a missing one an error."""
    missing = [c for c in columns if c not in df.columns]
    if strict and missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*(c for c in columns if c in df.columns))


def with_typed_nulls(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Adds the missing columns as nulls of the given type."""
    return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema`, in its order and types; what cannot be cast or is absent is null."""
    full = with_typed_nulls(df, {f.name: f.dataType.simpleString() for f in schema})
    return full.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def semi_filter(
    df: DataFrame, keys: DataFrame | None, column: str, key: str | None = None, on_missing: str = "keep"
) -> DataFrame:
    """Rows whose `column` occurs among the non-null `keys`.

    Without a key table (an upstream dataset failed) rows are all kept or all
    dropped, as `on_missing` says. Duplicate keys do not matter to a semi-join.
    """
    if keys is None:
        return df if on_missing == "keep" else df.limit(0)
    allowed = keys.select(F.col(key or column).alias("_key")).filter(F.col("_key").isNotNull())
    return df.join(allowed, df[column] == allowed["_key"], "left_semi")


def semi_any(df: DataFrame, keys: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Rows with at least one of `columns` among the non-null `keys`.

    One flagged equi-join per column instead of a semi-join on an OR, which
    would be a nested loop; keys are made distinct, so no row is doubled.
    """
    allowed = keys.select(F.col(key).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    hit = F.lit(False)
    flagged = df
    for i, column in enumerate(columns):
        side = allowed.select(F.col("_key").alias(f"_key{i}"), F.lit(True).alias(f"_hit{i}"))
        flagged = flagged.join(side, F.col(column) == F.col(f"_key{i}"), "left")
        hit = hit | F.col(f"_hit{i}").isNotNull()
    return flagged.filter(hit).select(*df.columns)


def enrich(df: DataFrame, dim: DataFrame, on: str, columns: Mapping[str, str]) -> DataFrame:
    """Left join of a narrow projection (alias -> column) of a dimension that is unique on `on`.

    No broadcast hint: Spark broadcasts the projection when its size allows and
    otherwise splits skewed keys of the sort-merge join (AQE).
    """
    return df.join(dim.select(on, *(F.col(c).alias(a) for a, c in columns.items())), on, "left")


def role_join(
    df: DataFrame, dim: DataFrame, key: str, roles: Mapping[str, Mapping[str, str]], how: str = "inner"
) -> DataFrame:
    """The same dimension joined once per foreign key; `roles` maps the key column to {alias: column}."""
    for fk, columns in roles.items():
        side = dim.select(F.col(key).alias(fk), *(F.col(c).alias(a) for a, c in columns.items()))
        df = df.join(side, fk, how)
    return df


def explode_path(df: DataFrame, path: str, where: Mapping[int, Column] | None = None, alias: str = "item") -> DataFrame:
    """Explodes the arrays along a dotted path, e.g. `standings.table`; empty arrays give no row.

    `where` holds a filter per level (0 = first array), written against `alias`.
    """
    where = where or {}
    source = ""
    for level, step in enumerate(path.split(".")):
        df = df.select(F.explode(F.col(source + step)).alias(alias))
        if level in where:
            df = df.filter(where[level])
        source = alias + "."
    return df


def _order(column: str | Column, descending: bool) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.desc_nulls_last() if descending else column.asc_nulls_first()


def top_n(
    df: DataFrame, by: str | Column, n: int, descending: bool = True, tie_break: Sequence[str] = ()
) -> DataFrame:
    """n rows by one column; nulls count as lowest. Plans as a per-task top-n with a merge."""
    return df.orderBy(_order(by, descending), *tie_break).limit(n)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in the listed columns."""
    return df.na.drop(subset=list(columns))


def lookup(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows whose column equals a value, taken literally."""
    return df.filter(F.col(column) == F.lit(value))


def adhoc(spark: SparkSession, text: str) -> DataFrame:
    """A read-only SQL text over the registered views, checked on its parsed plan."""
    return run_query_text(spark, text)
