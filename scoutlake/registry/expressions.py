"""Column functions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake import functions as fn
from scoutlake.registry import Query
from scoutlake.registry.oracle import fingerprint_sql, oracle, rounded
from scoutlake.registry.shapes import shape, table


def cleaned_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    raw = (
        F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("FC "), F.upper("p_name")))
        .when(F.col("p_size") % 5 == 1, F.concat("p_name", F.lit(" FC")))
        .when(F.col("p_size") % 5 == 2, F.concat(F.lit("SC "), "p_name", F.lit(" Campo ")))
        .when(F.col("p_size") % 5 == 3, F.concat(F.lit("  "), "p_name"))
    )
    named = part.select("p_partkey", raw.alias("raw"))
    return named.withColumn("key", fn.clean_name("raw"))


def text_matches(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    name = F.when(F.col("p_size") > 3, F.col("p_name"))
    return part.select(
        "p_partkey",
        fn.contains_ci(name, "RING").alias("any_case"),
        fn.contains_ci(name, "^(small|red) ").alias("pattern"),
        fn.contains_literal("p_brand", "#1").alias("literal"),
        fn.contains_literal("p_name", "r_ng").alias("underscore_is_literal"),
    )


def dates_and_ages(spark: SparkSession, sf: str) -> DataFrame:
    players = shape(spark, sf, "players").select("player_id", "date_of_birth", "contract_expiration_date")
    born, until = fn.parse_date("date_of_birth"), fn.parse_date("contract_expiration_date")
    return players.select(
        "player_id",
        born.alias("born"),
        fn.age_years(born, dt.date(2025, 6, 1)).alias("age"),
        fn.age_years(born, until).alias("age_at_expiry"),
        F.floor(fn.age_fraction(born, dt.date(2025, 6, 1)) * 1000).alias("age_thousandths"),
        fn.utc_now_text().rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$").alias("utc_text"),
    )


def guarded_rates(spark: SparkSession, sf: str) -> DataFrame:
    moves = shape(spark, sf, "transfers").withColumn("rest", F.col("to_club_id") % 4)
    return moves.select(
        "player_id",
        "from_club_id",
        "to_club_id",
        "transfer_date",
        fn.safe_div("market_value_in_eur", "rest").alias("quotient"),
        fn.safe_div("transfer_fee", "market_value_in_eur", 2).alias("fee_ratio"),
        fn.ratio_or_zero("market_value_in_eur", "rest").alias("ratio"),
        fn.per_90("rest", "from_club_id", 2).alias("per_90"),
        fn.in_millions("transfer_fee").alias("fee_m"),
        fn.coalesce_zero("transfer_fee", "double").alias("fee_or_zero"),
    )


def labels_and_differences(spark: SparkSession, sf: str) -> DataFrame:
    moves = shape(spark, sf, "transfers")
    return moves.select(
        "player_id",
        "from_club_id",
        "to_club_id",
        "transfer_date",
        fn.transfer_class("transfer_fee").alias("kind"),
        fn.fee_diff("transfer_fee", "market_value_in_eur").alias("diff"),
    )


def results_and_shares(spark: SparkSession, sf: str) -> DataFrame:
    games = shape(spark, sf, "games")
    home, away = F.col("home_club_goals"), F.col("away_club_goals")
    return games.select(
        "game_id",
        fn.match_result(home, away).alias("result"),
        fn.truncated_pct(fn.coalesce_zero(home), F.lit(7)).alias("pct_of_seven"),
        fn.score_goals(F.col("attendance") / 2.0).alias("even_half"),
        fn.tendency(home / 2.0 + away / 2.0).alias("tendency"),
        fn.expected_goals(home, away, F.lit(2.5)).alias("expected"),
    )


def player_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores on per-player inputs made from part columns; goals and assists vary with the key."""
    both = shape(spark, sf, "players").join(shape(spark, sf, "defense"), "player_id")
    goals, assists = (F.col("player_id") % 31).cast("int"), (F.col("player_id") % 17).cast("int")
    defence = ("tackles_per_90", "interceptions_per_90", "pass_completion_pct")
    reds = (F.col("player_id") % 3).cast("int")
    age = (F.col("player_id") % 20 + 18).cast("int")
    return both.select(
        "player_id",
        F.round(fn.impact_score("position", goals, assists, reds, *defence), 2).alias("impact"),
        F.round(fn.defensive_reliability(*defence), 2).alias("reliability"),
        fn.upside_value(F.nullif(age, F.lit(19)), "highest_market_value_in_eur", "market_value_in_eur").alias("upside"),
        fn.contributions_per_90(goals, assists, (F.col("player_id") % 900).cast("int")).alias("per_90"),
    )


# The types that both engines read from the files.
FINGERPRINTED = {
    "lineitem": {
        "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INTEGER", "l_quantity": "DOUBLE",
        "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE", "l_returnflag": "VARCHAR",
        "l_linestatus": "VARCHAR", "l_shipdate": "TIMESTAMP",
    },
    "orders": {
        "o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE",
        "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR",
    },
    "documents": {"doc_id": "BIGINT", "text": "VARCHAR", "lang": "VARCHAR", "source": "VARCHAR", "n_chars": "BIGINT"},
}


def table_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Schema and content fingerprints of the big tables."""
    parts = []
    for name in FINGERPRINTED:
        df = table(spark, sf, name)
        parts.append(
            fn.content_hash(df).select(
                F.lit(name).alias("table_name"), F.lit(fn.schema_hash(df)).alias("schema_hash"),
                F.lit(fn.schema_text(df)).alias("schema_text"), "rows", "content_hash",
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def fingerprint_invariance(spark: SparkSession, sf: str) -> DataFrame:
    """The content hash does not move with the order of the rows, and does with their content."""
    li = table(spark, sf, "lineitem")
    other = li.withColumn("l_tax", F.when(F.col("l_orderkey") == 0, 1.0).otherwise(F.col("l_tax")))
    shuffled = fn.content_hash(li.repartition(7, "l_partkey")).select(F.col("content_hash").alias("again"))
    changed = fn.content_hash(other).select(F.col("content_hash").alias("changed"))
    return fn.content_hash(li).select(
        "rows",
        (F.col("content_hash") == shuffled.scalar()).alias("same"),
        (F.col("content_hash") == changed.scalar()).alias("same_after_change"),
    )


def blanked(spark: SparkSession, sf: str) -> DataFrame:
    games = shape(spark, sf, "games").select("game_id", "home_club_goals", "attendance", "referee")
    return fn.blank_nulls(games)


CLEANED = """
    SELECT p_partkey, raw,
      trim(replace(replace(replace(replace(lower(coalesce(raw, '')), ' fc', ''), 'fc ', ''), ' ca', ''), 'sc ', '')) AS key
    FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'FC ' || upper(p_name) WHEN 1 THEN p_name || ' FC'
            WHEN 2 THEN 'SC ' || p_name || ' Campo ' WHEN 3 THEN '  ' || p_name END AS raw FROM part)"""

SCORES = f"""
    SELECT player_id, {rounded('score', 2)} AS impact,
      {rounded('tackles_per_90 * 2 + interceptions_per_90 * 1.5::DOUBLE + pass_completion_pct / 100 * 2', 2)} AS reliability,
      CASE WHEN age <= 29 THEN highest_market_value_in_eur - market_value_in_eur ELSE 0 END AS upside,
      {rounded('CAST(g + a AS DOUBLE) / nullif(player_id % 900, 0) * 90', 2)} AS per_90
    FROM (SELECT p.*, d.tackles_per_90, d.interceptions_per_90, d.pass_completion_pct,
            p.player_id % 31 AS g, p.player_id % 17 AS a, nullif(p.player_id % 20 + 18, 19) AS age,
            CASE position
              WHEN 'Attack' THEN g * 2.0::DOUBLE + a * 1.5::DOUBLE
              WHEN 'Midfield' THEN g * 1.5::DOUBLE + a * 1.5::DOUBLE + tackles_per_90 + pass_completion_pct / 100 * 2
              WHEN 'Defender' THEN tackles_per_90 * 2 + interceptions_per_90 * 1.5::DOUBLE + pass_completion_pct / 100 * 2
              WHEN 'Goalkeeper' THEN pass_completion_pct / 100 * 5 - p.player_id % 3 * 3
              ELSE CAST(g + a AS DOUBLE) END AS score
          FROM players p JOIN defense d ON d.player_id = p.player_id)"""

QUERIES = {
    "cleaned_names": Query(cleaned_names, CLEANED),
    "text_matches": Query(
        text_matches,
        """SELECT p_partkey, coalesce(p_size > 3 AND p_name ILIKE '%ring%', false) AS any_case,
             p_size > 3 AND regexp_matches(p_name, '^(small|red) ') AS pattern, contains(p_brand, '#1') AS literal,
             contains(p_name, 'r_ng') AS underscore_is_literal FROM part""",
    ),
    "dates_and_ages": Query(
        dates_and_ages,
        oracle("""SELECT player_id, born, CAST(floor(days / 365.25::DOUBLE) AS INT) AS age,
                    CAST(floor(date_diff('day', born, until) / 365.25::DOUBLE) AS INT) AS age_at_expiry,
                    CAST(floor(days / 365.25::DOUBLE * 1000) AS BIGINT) AS age_thousandths, true AS utc_text
                  FROM (SELECT player_id, TRY_CAST(date_of_birth AS DATE) AS born,
                          TRY_CAST(contract_expiration_date AS DATE) AS until,
                          date_diff('day', TRY_CAST(date_of_birth AS DATE), DATE '2025-06-01') AS days FROM players)"""),
    ),
    "guarded_rates": Query(
        guarded_rates,
        oracle(f"""SELECT player_id, from_club_id, to_club_id, transfer_date,
                     market_value_in_eur / nullif(rest, 0) AS quotient,
                     {rounded('transfer_fee / nullif(market_value_in_eur, 0)', 2)} AS fee_ratio,
                     coalesce(market_value_in_eur / CASE WHEN rest = 0 THEN 1 ELSE rest END, 0) AS ratio,
                     {rounded('CAST(rest AS DOUBLE) / nullif(from_club_id, 0) * 90', 2)} AS per_90,
                     transfer_fee / 1e6 AS fee_m, coalesce(transfer_fee, 0) AS fee_or_zero
                   FROM (SELECT *, to_club_id % 4 AS rest FROM transfers)"""),
    ),
    "labels_and_differences": Query(
        labels_and_differences,
        oracle("""SELECT player_id, from_club_id, to_club_id, transfer_date,
                    CASE WHEN transfer_fee IS NULL THEN 'unknown' WHEN transfer_fee = 0 THEN 'free/loan'
                         ELSE 'paid' END AS kind, transfer_fee - market_value_in_eur AS diff FROM transfers"""),
    ),
    "results_and_shares": Query(
        results_and_shares,
        oracle("""SELECT game_id, CASE WHEN h > a THEN 'win' WHEN h < a THEN 'loss' ELSE 'draw' END AS result,
                    CAST(coalesce(h, 0) * 100 // 7 AS BIGINT) AS pct_of_seven,
                    CAST(round_even(attendance / 2.0::DOUBLE, 0) AS INT) AS even_half,
                    CASE WHEN h / 2.0::DOUBLE + a / 2.0::DOUBLE >= 3.5 THEN 'open'
                         WHEN h / 2.0::DOUBLE + a / 2.0::DOUBLE >= 2.5 THEN 'balanced' ELSE 'closed' END AS tendency,
                    h * (a / 2.5::DOUBLE) AS expected
                  FROM (SELECT *, home_club_goals AS h, away_club_goals AS a FROM games)"""),
    ),
    "player_scores": Query(player_scores, oracle(SCORES)),
    "table_fingerprints": Query(
        table_fingerprints, " UNION ALL ".join(fingerprint_sql(name, columns) for name, columns in FINGERPRINTED.items())
    ),
    "fingerprint_invariance": Query(
        fingerprint_invariance, "SELECT count(*) AS rows, true AS same, false AS same_after_change FROM lineitem"
    ),
    "blanked": Query(
        blanked,
        oracle("""SELECT CAST(game_id AS VARCHAR) AS game_id,
                    coalesce(CAST(home_club_goals AS VARCHAR), '') AS home_club_goals,
                    coalesce(CAST(attendance AS VARCHAR), '') AS attendance, referee FROM games"""),
    ),
}
