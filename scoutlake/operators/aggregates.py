"""Grouped summaries. All of them combine map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from scoutlake.operators.ranges import middle_values
from scoutlake.operators.windows import latest_per_key


def sum_profile(
    df: DataFrame, key: str, sums: Mapping[str, str], count_of: str, count_alias: str
) -> DataFrame:
    """Sums (alias -> column) and the number of non-null `count_of` per key."""
    totals = [F.sum(column).alias(alias) for alias, column in sums.items()]
    return df.groupBy(key).agg(*totals, F.count(count_of).alias(count_alias))


def lineup_by_club(
    df: DataFrame, game: str = "game_id", club: str = "club_id", kind: str = "type", captain: str = "team_captain"
) -> DataFrame:
    """Starters, substitutes and captains per (game, club)."""
    def of_kind(label: str) -> Column:
        return F.coalesce(F.count_if(F.col(kind) == label), F.lit(0))

    return df.groupBy(game, club).agg(
        of_kind("starting_lineup").alias("starters"),
        of_kind("substitutes").alias("subs"),
        F.sum(F.col(captain).try_cast("int")).alias("captain_count"),
    )


def distinct_per_key(
    df: DataFrame, key: str, column: str, alias: str, approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per key. The exact form is grouped by (key, value)
    first, so a hot key spreads over the cluster; the approximate one keeps a sketch."""
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(key).agg(counter(column).alias(alias))


def first_last(
    df: DataFrame,
    entity: str,
    date: str,
    value: str,
    labels: Sequence[str] = (),
) -> DataFrame:
    """First and last date per entity, with the lowest first and the highest last value.

    Rows are per (entity, labels); a label variant that touches neither end of
    its entity's history gives no row, and neither does a null entity. One pass: the end values travel inside the
    minimum and maximum, so no row-sized shuffle and no self-join is needed.
    """
    dated = df.filter(F.col(date).isNotNull() & F.col(entity).isNotNull())
    known_first = F.struct(F.col(date).alias("d"), F.col(value).isNull().alias("unknown"), F.col(value).alias("v"))
    known_last = F.struct(F.col(date).alias("d"), F.col(value).alias("v"))
    ends = dated.groupBy(entity, *labels).agg(
        F.min(known_first).alias("_first"), F.max(known_last).alias("_last")
    )
    start, end = F.min("_first.d").alias("_start"), F.max("_last.d").alias("_stop")
    if labels:
        # A second partial aggregate, so that no task sees all label variants of an entity.
        placed = ends.join(ends.groupBy(entity).agg(start, end), entity)
    else:
        placed = ends.withColumns({"_start": F.col("_first.d"), "_stop": F.col("_last.d")})
    at_start = F.col("_first.d") == F.col("_start")
    at_stop = F.col("_last.d") == F.col("_stop")
    return placed.filter(at_start | at_stop).select(
        entity,
        *labels,
        F.when(at_start, F.col("_start")).otherwise(F.col("_stop")).alias("first_date"),
        F.when(at_stop, F.col("_stop")).otherwise(F.col("_start")).alias("last_date"),
        F.when(at_start, F.col("_first.v")).alias("first_value"),
        F.when(at_stop, F.col("_last.v")).alias("last_value"),
    )


def dedup_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first under `order_by`."""
    return latest_per_key(df, keys, order_by)


def dropped_by_dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: `rows`, `kept`, `dropped` of a dedup on `keys`, without running the dedup."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return per_key.agg(total.alias("rows"), F.count("*").alias("kept")).withColumn(
        "dropped", F.col("rows") - F.col("kept")
    )


def union_counts(tables: Mapping[str, DataFrame], label: str = "table_name", count: str = "row_count") -> DataFrame:
    """One labelled row count per table."""
    counted = [df.agg(F.count("*").alias(count)).select(F.lit(name).alias(label), count) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row with the interpolated median of the non-null values; null without any.

    Equal values are counted first. The counts are dealt to ranges of the value, and only
    the ranges that hold the middle ranks are counted through, so no task sees all values.
    """
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    middle = middle_values(counted, "value", "n")
    return middle.select((F.col("low") * F.lit(0.5) + F.col("high") * F.lit(0.5)).cast("double").alias("median"))


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Nulls replaced by the column's median, a scalar subquery."""
    return df.withColumn(column, F.coalesce(F.col(column), exact_median(df, column).scalar()))


def with_means(df: DataFrame, means: Mapping[str, str], over: DataFrame | None = None) -> DataFrame:
    """Column means (alias -> column) of `over`, default `df`, on every row, as scalar subqueries."""
    base = over if over is not None else df
    return df.withColumns({alias: base.agg(F.avg(column)).scalar() for alias, column in means.items()})


def home_away_strength(
    games: DataFrame, min_games: int = 10, where: Column | None = None
) -> DataFrame:
    """Goals for and against per club at home and away, for clubs with enough games in both roles."""
    played = games.filter(where) if where is not None else games
    home = played.groupBy(F.col("home_club_id").alias("club_id"), F.col("home_club_name").alias("club_name")).agg(
        F.avg("home_club_goals").alias("avg_goals_scored_home"),
        F.avg("away_club_goals").alias("avg_goals_conceded_home"),
        F.count("*").alias("home_games"),
    )
    away = played.groupBy(F.col("away_club_id").alias("club_id")).agg(
        F.avg("away_club_goals").alias("avg_goals_scored_away"),
        F.avg("home_club_goals").alias("avg_goals_conceded_away"),
        F.count("*").alias("away_games"),
    )
    enough = (F.col("home_games") >= min_games) & (F.col("away_games") >= min_games)
    both = home.join(away, "club_id").filter(enough)
    return both.withColumns(
        {
            "overall_attack": (F.col("avg_goals_scored_home") + F.col("avg_goals_scored_away")) / 2,
            "overall_defense": (F.col("avg_goals_conceded_home") + F.col("avg_goals_conceded_away")) / 2,
        }
    )
