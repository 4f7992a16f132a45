"""Football-shaped projections of the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_VALUE = "floor(p_retailprice) * (500 + p_partkey % 13 * 700)"
_DAY = "CAST(CAST({0} AS DATE) AS STRING)"
_TEXT = "CAST({0} AS STRING)"

# name -> (driver table, row condition or None, {column: expression})
SHAPES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "competitions": (
        "nation",
        None,
        {
            "competition_id": "CASE n_nationkey WHEN 0 THEN 'GB1' WHEN 1 THEN 'ES1' WHEN 2 THEN 'IT1' WHEN 3 THEN 'L1' "
            "WHEN 4 THEN 'FR1' WHEN 5 THEN 'BRA1' ELSE 'X' || CAST(n_nationkey AS STRING) END",
            "name": "lower(n_name)",
            "type": "CASE WHEN n_nationkey % 4 = 3 THEN 'domestic_cup' ELSE 'domestic_league' END",
            "sub_type": "'tier_' || CAST(n_regionkey AS STRING)",
            "country_name": "n_name",
        },
    ),
    "clubs": (
        "supplier",
        None,
        {
            "club_id": "s_suppkey",
            "club_code": "lower(s_name)",
            "name": "'Club ' || CAST(s_suppkey AS STRING) || ' FC'",
            "domestic_competition_id": "CASE s_nationkey % 8 WHEN 0 THEN 'GB1' WHEN 1 THEN 'ES1' WHEN 2 THEN 'IT1' "
            "WHEN 3 THEN 'L1' WHEN 4 THEN 'FR1' WHEN 5 THEN 'BRA1' ELSE 'X' || CAST(s_nationkey AS STRING) END",
            "stadium_name": "'Stadium ' || CAST(s_nationkey AS STRING)",
            "stadium_seats": "CAST(10000 + s_suppkey % 50 * 1000 AS INT)",
            "squad_size": "CAST(20 + s_suppkey % 15 AS INT)",
            "average_age": "CAST(20 + s_suppkey % 12 AS DOUBLE)",
            "foreigners_number": "CAST(s_suppkey % 18 AS INT)",
            "foreigners_percentage": "CAST(s_suppkey % 18 AS DOUBLE) * 4",
            "national_team_players": "CAST(s_suppkey % 9 AS INT)",
            "coach_name": "'Coach ' || CAST(s_suppkey AS STRING)",
            "net_transfer_record": "CAST(CAST(floor(s_acctbal) AS BIGINT) AS STRING) || 'k'",
        },
    ),
    "players": (
        "part",
        None,
        {
            "player_id": "p_partkey",
            "name": "p_name || ' ' || CAST(p_partkey AS STRING)",
            "first_name": "p_brand",
            "last_name": "p_name",
            "date_of_birth": "CASE WHEN p_partkey % 97 = 13 THEN 'unknown' "
            "ELSE CAST(DATE '1988-01-01' + CAST(p_partkey * 37 % 7000 AS INT) AS STRING) END",
            "country_of_citizenship": "p_brand",
            "country_of_birth": "'Land ' || CAST(p_size % 7 AS STRING)",
            "position": "CASE p_type WHEN 'ECONOMY' THEN 'Attack' WHEN 'STANDARD' THEN 'Attack' "
            "WHEN 'LARGE' THEN 'Midfield' WHEN 'MEDIUM' THEN 'Defender' WHEN 'PROMO' THEN 'Goalkeeper' ELSE NULL END",
            "sub_position": "p_type",
            "foot": "CASE WHEN p_size % 2 = 0 THEN 'left' ELSE 'right' END",
            "height_in_cm": "CASE WHEN p_partkey % 53 = 5 THEN NULL ELSE CAST(165 + p_size % 35 AS DOUBLE) END",
            "current_club_id": "p_partkey % 100",
            "current_club_name": "'Club ' || CAST(p_partkey % 100 AS STRING)",
            "market_value_in_eur": "CASE WHEN p_partkey % 41 = 7 THEN NULL WHEN p_partkey % 43 = 9 THEN CAST(0 AS DOUBLE) "
            f"ELSE CAST({_VALUE} AS DOUBLE) END",
            "highest_market_value_in_eur": f"CAST({_VALUE} * (1 + p_size % 4) AS DOUBLE)",
            "contract_expiration_date": "CAST(DATE '2025-01-01' + CAST(p_partkey * 11 % 1200 AS INT) AS STRING)",
            "agent_name": "'Agent ' || CAST(p_size % 9 AS STRING)",
            "image_url": "'https://img.example/' || CAST(p_partkey AS STRING)",
        },
    ),
    "defense": (
        "part",
        None,
        {
            # A negated key belongs to no player.
            "player_id": "CASE WHEN p_partkey % 3 = 1 THEN -p_partkey ELSE p_partkey END",
            "tackles_per_90": "CAST(p_size % 8 AS DOUBLE) + CAST(0.25 AS DOUBLE)",
            "interceptions_per_90": "CAST(p_size % 5 AS DOUBLE) + CAST(0.5 AS DOUBLE)",
            "pass_completion_pct": "CAST(60 + p_size % 40 AS DOUBLE)",
        },
    ),
    "appearances": (
        "lineitem",
        None,
        {
            "appearance_id": "CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN NULL "
            "ELSE CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) END",
            "player_id": "CASE WHEN l_partkey % 11 = 3 THEN -l_partkey ELSE l_partkey END",
            "goals": "CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(l_linenumber % 3 AS INT) END",
            "assists": "CAST(l_quantity AS INT) % 2",
            "yellow_cards": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
            "red_cards": "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 1 ELSE 0 END",
            "minutes_played": "45 + CAST(l_quantity AS INT)",
        },
    ),
    "player_valuations": (
        "lineitem",
        None,
        {
            "player_id": "l_partkey",
            "date": _DAY.format("l_shipdate"),
            "market_value_in_eur": "CASE WHEN l_quantity = 13 THEN NULL WHEN l_quantity = 14 THEN CAST(0 AS DOUBLE) "
            "ELSE CAST(floor(l_extendedprice) * 100 AS DOUBLE) END",
            "current_club_name": "'Club ' || CAST(l_suppkey AS STRING)",
            "current_club_id": "l_suppkey",
            "player_club_domestic_competition_id": "'C' || CAST(l_suppkey % 8 AS STRING)",
        },
    ),
    "transfers": (
        "lineitem",
        None,
        {
            "player_id": "l_partkey",
            "player_name": "'Player ' || CAST(l_partkey AS STRING)",
            "transfer_date": _DAY.format("l_shipdate"),
            "transfer_season": "substr(" + _DAY.format("l_shipdate") + ", 3, 2)",
            "from_club_id": "l_suppkey",
            "from_club_name": "'Club ' || CAST(l_suppkey AS STRING)",
            "to_club_id": "l_orderkey % 100",
            "to_club_name": "'Club ' || CAST(l_orderkey % 100 AS STRING)",
            "transfer_fee": "CASE WHEN l_discount = 0.1 THEN NULL WHEN l_discount = 0.05 THEN CAST(0 AS DOUBLE) "
            "ELSE CAST(floor(l_extendedprice) * 100 AS DOUBLE) END",
            "market_value_in_eur": "CASE WHEN l_tax = 0.08 THEN NULL ELSE l_quantity * 150000 END",
        },
    ),
    "games": (
        "orders",
        None,
        {
            "game_id": "o_orderkey",
            "competition_id": "CASE o_custkey % 8 WHEN 0 THEN 'GB1' WHEN 1 THEN 'ES1' WHEN 2 THEN 'IT1' WHEN 3 THEN 'L1' "
            "WHEN 4 THEN 'FR1' WHEN 5 THEN 'BRA1' ELSE 'X' || CAST(o_custkey % 8 AS STRING) END",
            "competition_type": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'domestic_cup' ELSE 'domestic_league' END",
            "season": "substr(" + _DAY.format("o_orderdate") + ", 1, 4)",
            "round": "o_orderpriority",
            "date": _DAY.format("o_orderdate"),
            "home_club_id": "o_custkey % 100",
            "away_club_id": "o_orderkey * 7 % 100",
            "home_club_name": "'Team ' || CAST(o_custkey % 100 AS STRING) || ' FC'",
            "away_club_name": "'Team ' || CAST(o_orderkey * 7 % 100 AS STRING) || ' FC'",
            "home_club_goals": "CASE WHEN o_orderstatus = 'P' THEN NULL "
            "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 6 AS INT) END",
            "away_club_goals": "CASE WHEN o_orderstatus = 'P' THEN NULL "
            "ELSE CAST(CAST(floor(o_totalprice / 7) AS BIGINT) % 5 AS INT) END",
            "stadium": "'Stadium ' || CAST(o_custkey % 100 AS STRING)",
            "attendance": "CASE WHEN o_orderkey % 19 = 3 THEN NULL ELSE CAST(floor(o_totalprice / 10) AS INT) END",
            "referee": "'Referee ' || CAST(o_orderkey % 31 AS STRING)",
            "home_club_formation": "CASE WHEN o_orderkey % 2 = 0 THEN '4-4-2' ELSE '4-3-3' END",
            "away_club_formation": "CASE WHEN o_orderkey % 3 = 0 THEN '3-5-2' ELSE '4-2-3-1' END",
            "home_club_manager_name": "'Coach ' || CAST(o_custkey % 100 AS STRING)",
            "away_club_manager_name": "'Coach ' || CAST(o_orderkey * 7 % 100 AS STRING)",
        },
    ),
    "game_lineups": (
        "lineitem",
        None,
        {
            "game_id": "CASE WHEN l_orderkey % 17 = 4 THEN -l_orderkey ELSE l_orderkey END",
            "club_id": "l_suppkey",
            "player_id": "CASE WHEN l_quantity = 1 THEN NULL ELSE l_partkey END",
            "type": "CASE WHEN l_returnflag = 'N' THEN 'bench' WHEN l_linestatus = 'F' THEN 'starting_lineup' "
            "ELSE 'substitutes' END",
            "team_captain": "CASE WHEN l_linenumber = 1 THEN 1 WHEN l_linenumber = 2 THEN NULL ELSE 0 END",
        },
    ),
    # Flat rows behind the JSON payloads.
    "match_rows": (
        "orders",
        None,
        {
            "match_id": "o_orderkey",
            "matchday": "CAST(o_custkey % 38 AS INT)",
            "utc_date": _DAY.format("o_orderdate") + " || 'T21:30:00Z'",
            "status": "CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'SCHEDULED' ELSE 'POSTPONED' END",
            "home_id": "o_custkey % 100",
            "away_id": "o_orderkey * 7 % 100",
            "home_goals": "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 6 AS INT) END",
            "away_goals": "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(floor(o_totalprice / 7) AS BIGINT) % 5 AS INT) END",
            "winner": "CASE WHEN o_orderstatus = 'F' THEN 'HOME_TEAM' END",
            "season_start": "substr(" + _DAY.format("o_orderdate") + ", 1, 4) || '-01-28'",
            "season_end": "substr(" + _DAY.format("o_orderdate") + ", 1, 4) || '-12-02'",
        },
    ),
    "table_rows": (
        "customer",
        None,
        {
            "doc": "CAST(floor(c_custkey / 20) AS BIGINT)",
            "type": "CASE CAST(floor(c_custkey / 20) AS BIGINT) % 3 WHEN 0 THEN 'TOTAL' WHEN 1 THEN 'HOME' ELSE 'TOTAL' END",
            "position": "CAST(c_custkey % 20 + 1 AS INT)",
            "team_id": "c_custkey",
            "team_name": "'CLUB ' || CAST(CAST(floor(c_custkey / 15) AS BIGINT) AS STRING)",
            "played": "38",
            "won": "CAST(c_custkey % 25 AS INT)",
            "draw": "CAST(c_custkey % 7 AS INT)",
            "lost": "CAST(38 - c_custkey % 25 - c_custkey % 7 AS INT)",
            "points": "CAST(c_custkey % 25 * 3 + c_custkey % 7 AS INT)",
            "goals_for": "CAST(20 + c_custkey % 60 AS INT)",
            "goals_against": "CAST(20 + c_nationkey AS INT)",
            "goal_difference": "CAST(c_custkey % 60 - c_nationkey AS INT)",
            "form": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'W,D,L' END",
        },
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, where, columns = SHAPES[name]
    df = table(spark, sf_dir, source)
    if where:
        df = df.filter(where)
    return df.selectExpr(*(f"{expr} AS `{alias}`" for alias, expr in columns.items()))


def shape_sql(name: str) -> str:
    source, where, columns = SHAPES[name]
    listed = ", ".join(f'{expr} AS "{alias}"' for alias, expr in columns.items())
    return f"SELECT {listed} FROM {source}" + (f" WHERE {where}" if where else "")


def match_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`item` structs of the matches payload."""
    rows = shape(spark, sf_dir, "match_rows")

    def team(side: str):
        number = F.col(f"{side}_id").cast("string")
        return F.struct(
            F.col(f"{side}_id").alias("id"),
            F.concat(F.lit("TEAM "), number).alias("name"),
            F.concat(F.lit("T"), number).alias("shortName"),
            F.lit(None).cast("string").alias("crest"),
        )

    full_time = F.struct(F.col("home_goals").alias("home"), F.col("away_goals").alias("away"))
    item = F.struct(
        F.col("match_id").alias("id"),
        "matchday",
        F.col("utc_date").alias("utcDate"),
        "status",
        team("home").alias("homeTeam"),
        team("away").alias("awayTeam"),
        F.struct("winner", full_time.alias("fullTime")).alias("score"),
        F.struct(F.col("season_start").alias("startDate"), F.col("season_end").alias("endDate")).alias("season"),
    )
    return rows.select(item.alias("item"))


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped documents of ten matches each, as an endpoint delivers them."""
    items = match_items(spark, sf_dir)
    batches = items.groupBy(F.floor(F.col("item.id") / 10).alias("doc")).agg(
        F.sort_array(F.collect_list("item")).alias("matches")
    )
    return batches.select("matches")


def standing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`item` structs of the standings payload: one group of twenty clubs each."""
    rows = shape(spark, sf_dir, "table_rows")
    team = F.struct(
        F.col("team_id").alias("id"),
        F.col("team_name").alias("name"),
        F.substring("team_name", 1, 3).alias("shortName"),
        F.lit(None).cast("string").alias("crest"),
    )
    # Payload field of each flat column.
    names = {
        "played": "playedGames", "won": "won", "draw": "draw", "lost": "lost", "points": "points",
        "goals_for": "goalsFor", "goals_against": "goalsAgainst", "goal_difference": "goalDifference",
        "form": "form",
    }
    row = F.struct("position", team.alias("team"), *(F.col(c).alias(a) for c, a in names.items()))
    groups = rows.groupBy("doc", "type").agg(F.sort_array(F.collect_list(row)).alias("table"))
    return groups.select(F.struct("type", "table").alias("item"))
