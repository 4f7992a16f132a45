"""Projections, filters, joins, aggregates, top-k and unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake.contracts import CSV_COMPETITIONS
from scoutlake.operators import aggregates as agg, relational as rel
from scoutlake.operators.query_builder import Filter, QuerySpec, build_query
from scoutlake.plans.scout_view import VIEW_NAME, scout_view
from scoutlake.registry import Query, gold
from scoutlake.registry.oracle import oracle
from scoutlake.registry.shapes import shape, standing_items, table

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def tolerant_projection(spark: SparkSession, sf: str) -> DataFrame:
    """Listed columns that exist, with missing ones as typed nulls, one renamed and one dropped."""
    df = table(spark, sf, "customer").withColumnRenamed("c_name", "name").drop("c_acctbal")
    df = rel.select_existing(df, ["c_custkey", "name", "no_such_column", "c_mktsegment"])
    return rel.with_typed_nulls(df, {"age": "int", "c_mktsegment": "string"})


def tolerant_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Order priorities start with a digit; the rest of the text does not cast."""
    orders = table(spark, sf, "orders")
    level = F.substring("o_orderpriority", 1, 1)
    return orders.select(
        "o_orderkey",
        level.try_cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.col("o_orderkey").cast("double").alias("key_as_double"),
        F.to_date("o_orderdate").cast("string").alias("day_as_text"),
    )


def total_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Nested arrays exploded level by level, with a filter on the first level."""
    docs = standing_items(spark, sf).select(F.array("item").alias("standings"))
    rows = rel.explode_path(docs, "standings.table", where={0: F.col("item.type") == "TOTAL"})
    return rows.select("item.position", "item.team.id", "item.team.name", "item.playedGames")


def range_filter(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    wanted = (F.col("l_quantity") >= 10) & (F.col("l_quantity") <= 20) & (F.col("l_discount") < 0.04)
    return li.filter(wanted).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount")


def date_range(spark: SparkSession, sf: str) -> DataFrame:
    """The bounds are typed like the column, so the comparison reaches the Parquet scan."""
    low, high = (F.lit(day).cast("timestamp_ntz") for day in (dt.date(1997, 1, 1), dt.date(1997, 12, 31)))
    kept = table(spark, sf, "orders").filter(F.col("o_orderdate").between(low, high))
    return kept.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


def null_predicates(spark: SparkSession, sf: str) -> DataFrame:
    games = shape(spark, sf, "games").select("game_id", "home_club_goals", "attendance")
    return games.filter(F.col("home_club_goals").isNotNull() & F.col("attendance").isNull())


def chosen_competitions(spark: SparkSession, sf: str) -> DataFrame:
    return shape(spark, sf, "competitions").filter(F.col("competition_id").isin(*CSV_COMPETITIONS))


def competitions_of_country(spark: SparkSession, sf: str) -> DataFrame:
    return rel.lookup(shape(spark, sf, "competitions"), "country_name", "NATION_5").select(
        "competition_id", "name", "sub_type", "type"
    )


def complete_players(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["player_id", "height_in_cm", "market_value_in_eur", "position"]
    return rel.drop_incomplete(shape(spark, sf, "players").select(*columns), columns[1:])


def built_query(spark: SparkSession, sf: str) -> DataFrame:
    spec = QuerySpec(
        columns=("player_id", "player_name", "age", "club_name", "tackles_per_90", "contributions_per_90"),
        filters=(
            Filter("age", "<=", "24"),
            Filter("total_minutes", ">", "1500"),
            Filter("player_name", "LIKE", "ring"),
            Filter("position", "!=", "Goalkeeper"),
            Filter("nationality", "=", ""),
        ),
        order_by=("player_id",),
    )
    return build_query(_scout(spark, sf), spec)


def player_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return rel.lookup(_scout(spark, sf), "nationality", "Brand#7")


def _scout(spark: SparkSession, sf: str) -> DataFrame:
    return scout_view(gold.players(spark, sf), shape(spark, sf, "clubs"))


ADHOC = f"""
WITH by_position AS (
  SELECT position, count(*) AS players, max(age) AS oldest, sum(goal_contributions) AS contributions
  FROM {VIEW_NAME} WHERE age IS NOT NULL GROUP BY position
)
SELECT * FROM by_position WHERE players > 10  -- read-only text
"""


def adhoc_text(spark: SparkSession, sf: str) -> DataFrame:
    _scout(spark, sf).createOrReplaceTempView(VIEW_NAME)
    return rel.adhoc(spark, ADHOC)


def enriched_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A fact with a narrow dimension projection; only the columns used are scanned."""
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_extendedprice")
    return rel.enrich(li, table(spark, sf, "part"), "p_partkey", {"kind": "p_type", "size": "p_size"})


def semi_cascade(spark: SparkSession, sf: str) -> DataFrame:
    region = table(spark, sf, "region").filter(F.col("r_name").isin("ASIA", "EUROPE"))
    nation = rel.semi_filter(table(spark, sf, "nation"), region, "n_regionkey", "r_regionkey")
    customer = rel.semi_filter(table(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey")
    orders = rel.semi_filter(table(spark, sf, "orders"), customer, "o_custkey", "c_custkey")
    lines = rel.semi_filter(table(spark, sf, "lineitem"), orders, "l_orderkey", "o_orderkey")
    return rel.semi_filter(lines, None, "l_orderkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


def club_in_set_either_side(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "supplier").filter("s_nationkey < 4")
    moves = shape(spark, sf, "transfers").select("player_id", "from_club_id", "to_club_id", "transfer_date")
    return rel.semi_any(moves, keys, ["from_club_id", "to_club_id"], "s_suppkey")


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return agg.union_counts({name: table(spark, sf, name) for name in TABLES})


def deduplicated_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice")]
    return agg.dedup_by_key(li, ["l_orderkey", "l_linenumber"], order)


def dropped_lines(spark: SparkSession, sf: str) -> DataFrame:
    return agg.dropped_by_dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def distinct_names(spark: SparkSession, sf: str) -> DataFrame:
    return shape(spark, sf, "games").select("home_club_name").filter(F.col("home_club_name").isNotNull()).distinct()


def deviation_from_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Whole euros add up exactly, so the mean is the same for any order of the rows."""
    games = shape(spark, sf, "games").select("game_id", F.col("attendance").cast("double").alias("attendance"))
    with_mean = agg.with_means(games, {"mean_attendance": "attendance"})
    return with_mean.withColumn("above", F.col("attendance") > F.col("mean_attendance"))


def median_height(spark: SparkSession, sf: str) -> DataFrame:
    return agg.exact_median(shape(spark, sf, "players"), "height_in_cm")


def filled_heights(spark: SparkSession, sf: str) -> DataFrame:
    return agg.fill_median(shape(spark, sf, "players").select("player_id", "height_in_cm"), "height_in_cm")


def dearest_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return rel.top_n(li, "l_extendedprice", 25, tie_break=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def cheapest_values(spark: SparkSession, sf: str) -> DataFrame:
    """Ascending: unknown values come first."""
    players = shape(spark, sf, "players").select("player_id", "market_value_in_eur")
    return rel.top_n(players, "market_value_in_eur", 60, descending=False, tie_break=["player_id"])


def sorted_segments(spark: SparkSession, sf: str) -> DataFrame:
    per = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("customers"))
    return per.orderBy(F.desc("customers"), "c_mktsegment")


def distinct_parts_per_order(spark: SparkSession, sf: str) -> DataFrame:
    return agg.distinct_per_key(table(spark, sf, "lineitem"), "l_orderkey", "l_suppkey", "suppliers")


QUERIES = {
    "tolerant_projection": Query(
        tolerant_projection,
        "SELECT c_custkey, c_name AS name, c_mktsegment, CAST(NULL AS INT) AS age FROM customer",
    ),
    "tolerant_casts": Query(
        tolerant_casts,
        """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS level,
             TRY_CAST(o_orderpriority AS INT) AS not_a_number, CAST(o_orderkey AS DOUBLE) AS key_as_double,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day_as_text FROM orders""",
    ),
    "total_groups": Query(
        total_groups,
        oracle("""SELECT position, team_id AS id, team_name AS name, played AS "playedGames"
                  FROM table_rows WHERE type = 'TOTAL'"""),
    ),
    "range_filter": Query(
        range_filter,
        """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount FROM lineitem
           WHERE l_quantity BETWEEN 10 AND 20 AND l_discount < 0.04""",
    ),
    "date_range": Query(
        date_range,
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
           WHERE o_orderdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""",
    ),
    "null_predicates": Query(
        null_predicates,
        oracle("""SELECT game_id, home_club_goals, attendance FROM games
                  WHERE home_club_goals IS NOT NULL AND attendance IS NULL"""),
    ),
    "chosen_competitions": Query(
        chosen_competitions,
        oracle("SELECT * FROM competitions WHERE competition_id IN ('GB1', 'ES1', 'IT1', 'L1', 'FR1', 'BRA1')"),
    ),
    "competitions_of_country": Query(
        competitions_of_country,
        oracle("SELECT competition_id, name, sub_type, type FROM competitions WHERE country_name = 'NATION_5'"),
    ),
    "complete_players": Query(
        complete_players,
        oracle("""SELECT player_id, height_in_cm, market_value_in_eur, position FROM players
                  WHERE height_in_cm IS NOT NULL AND market_value_in_eur IS NOT NULL AND position IS NOT NULL"""),
    ),
    "built_query": Query(
        built_query,
        oracle("""SELECT player_id, player_name, age, club_name, tackles_per_90, contributions_per_90 FROM scout
                  WHERE age <= 24 AND total_minutes > 1500 AND player_name LIKE '%ring%' AND position <> 'Goalkeeper'
                  ORDER BY player_id LIMIT 50"""),
    ),
    "player_lookup": Query(player_lookup, oracle("SELECT * FROM scout WHERE nationality = 'Brand#7'")),
    "adhoc_text": Query(
        adhoc_text,
        oracle("""SELECT position, count(*) AS players, max(age) AS oldest,
                    CAST(sum(goal_contributions) AS BIGINT) AS contributions
                  FROM scout WHERE age IS NOT NULL GROUP BY position HAVING count(*) > 10"""),
    ),
    "enriched_lines": Query(
        enriched_lines,
        """SELECT l_partkey AS p_partkey, l_orderkey, l_extendedprice, p_type AS kind, p_size AS size
           FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    ),
    "semi_cascade": Query(
        semi_cascade,
        """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey IN (
             SELECT o_orderkey FROM orders WHERE o_custkey IN (
               SELECT c_custkey FROM customer WHERE c_nationkey IN (
                 SELECT n_nationkey FROM nation WHERE n_regionkey IN (
                   SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE')))))""",
    ),
    "club_in_set_either_side": Query(
        club_in_set_either_side,
        oracle("""SELECT player_id, from_club_id, to_club_id, transfer_date FROM transfers
                  WHERE from_club_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 4)
                     OR to_club_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 4)"""),
    ),
    "row_counts": Query(
        row_counts,
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
    ),
    "deduplicated_lines": Query(
        deduplicated_lines,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
             ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1""",
    ),
    "dropped_lines": Query(
        dropped_lines,
        """SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS kept,
             count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS dropped FROM lineitem""",
    ),
    "distinct_names": Query(distinct_names, oracle("SELECT DISTINCT home_club_name FROM games")),
    "deviation_from_mean": Query(
        deviation_from_mean,
        oracle("""SELECT game_id, CAST(attendance AS DOUBLE) AS attendance,
                    (SELECT avg(attendance) FROM games) AS mean_attendance,
                    attendance > (SELECT avg(attendance) FROM games) AS above FROM games"""),
    ),
    "median_height": Query(median_height, oracle("SELECT median(height_in_cm) AS median FROM players")),
    "filled_heights": Query(
        filled_heights,
        oracle("""SELECT player_id, coalesce(height_in_cm, (SELECT median(height_in_cm) FROM players))
                    AS height_in_cm FROM players"""),
    ),
    "dearest_lines": Query(
        dearest_lines,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
           ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 25""",
    ),
    "cheapest_values": Query(
        cheapest_values,
        oracle("""SELECT player_id, market_value_in_eur FROM players
                  ORDER BY market_value_in_eur ASC NULLS FIRST, player_id LIMIT 60"""),
    ),
    "sorted_segments": Query(
        sorted_segments,
        """SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment
           ORDER BY customers DESC, c_mktsegment""",
    ),
    "suppliers_per_order": Query(
        distinct_parts_per_order,
        "SELECT l_orderkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_orderkey",
    ),
}
