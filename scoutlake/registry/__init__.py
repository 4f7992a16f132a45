"""Registered queries: the jobs and operators on the driver tables, with SQL oracles.

The driver tables hold no football data. `shapes` projects them into the raw
inputs of the jobs, row for row, with expressions that mean the same in Spark
SQL and in DuckDB, so both sides of a comparison start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


def all_queries() -> dict[str, Query]:
    from scoutlake.registry import expressions, files, gold, models, names, relations, reports, series

    found: dict[str, Query] = {}
    for module in (relations, expressions, series, gold, reports, names, files, models):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query registered twice: {name}")
            found[name] = query
    return found
