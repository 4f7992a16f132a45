"""Column/filter/limit requests turned into typed DataFrame predicates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.functions.text import contains_literal

OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


@dataclass(frozen=True)
class Filter:
    column: str
    op: str
    value: Any


@dataclass(frozen=True)
class QuerySpec:
    columns: Sequence[str] = ()
    filters: Sequence[Filter] = field(default_factory=tuple)
    limit: int = 50
    order_by: Sequence[str] = ()


def predicate(df: DataFrame, spec: Filter) -> Column:
    """One comparison; the value takes the column's type, so no text is ever spliced. A value that has none is an error."""
    if spec.op == "LIKE":
        return contains_literal(spec.column, str(spec.value))
    if spec.op not in OPERATORS:
        raise ValueError(f"unknown operator: {spec.op}")
    kind = df.schema[spec.column].dataType
    # One value, cast by Spark itself, so that it is read as a cell of the column would be.
    value = df.sparkSession.range(1).select(F.lit(spec.value).try_cast(kind).alias("v")).first().v
    if value is None:
        raise ValueError(f"no {kind.simpleString()} for {spec.column}: {spec.value!r}")
    return OPERATORS[spec.op](F.col(spec.column), F.lit(spec.value).try_cast(kind))


def build_query(df: DataFrame, spec: QuerySpec) -> DataFrame:
    """AND of all filters that have a column and a value; all columns when none is named.

    Without `order_by` a limit takes any rows.
    """
    active = [f for f in spec.filters if f.column and f.value not in ("", None)]
    named = [*spec.columns, *(f.column for f in active), *spec.order_by]
    unknown = sorted({c for c in named if c not in df.columns})
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    for f in active:
        df = df.filter(predicate(df, f))
    if spec.order_by:
        df = df.orderBy(*spec.order_by)
    return df.limit(spec.limit).select(*(spec.columns or df.columns))
