"""Files: scans, sinks, checks, ingest, load and the whole refresh.

Every query writes what it derives from the driver tables to a new folder below
the shared one, and reads it back through the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scoutlake.contracts import GOLD, MATCH_ITEM, RAW_CSV, STAR_KEYS, STAR_TABLES
from scoutlake.plans import reports
from scoutlake.plans.gold import match_rows
from scoutlake.plans.scout_view import scout_view
from scoutlake.plans.transform import transform_layer
from scoutlake.registry import Query, gold as gold_registry
from scoutlake.registry.gold import AS_OF
from scoutlake.registry.oracle import oracle
from scoutlake.registry.reports import IMPACT
from scoutlake.registry.shapes import match_documents, match_items, shape, standing_items, table
from scoutlake.session import work_dir
from scoutlake.sources import audit, ingest, quality, readers, sinks, star


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "csv")
    sinks.write_csv(shape(spark, sf, "appearances"), path)
    return readers.read_csv(spark, path, RAW_CSV["appearances"])


def gzip_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "gzip")
    shape(spark, sf, "player_valuations").write.option("header", True).option("compression", "gzip").csv(path)
    return readers.read_csv(spark, path, RAW_CSV["player_valuations"], min_partitions=8)


def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """All seasons and columns; the reader takes the season from the folder names."""
    path = work_dir(spark, "parquet")
    games = shape(spark, sf, "games").withColumn("date", F.to_date("date"))
    sinks.write_parquet(games, path, sort_by=["date"], partition_by=["season"])
    kept = readers.read_parquet(spark, path).withColumn("season", F.col("season").cast("string"))
    return kept.select(games.columns)


def wrapped_json(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "json")
    sinks.write_json(match_documents(spark, sf), path)
    return match_rows(readers.read_wrapped_json(spark, path, "matches", MATCH_ITEM, multiline=False))


def bare_json(spark: SparkSession, sf: str) -> DataFrame:
    path = work_dir(spark, "json")
    sinks.write_json(match_items(spark, sf).select("item.*"), path)
    return match_rows(readers.read_wrapped_json(spark, path, "matches", MATCH_ITEM, multiline=False))


def league_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Raw items of several per-league folders in one scan."""
    path = work_dir(spark, "payloads")
    docs = match_documents(spark, sf).withColumn("league", F.col("matches")[0]["matchday"] % 6)
    docs.write.partitionBy("league").json(path)
    items = readers.read_payloads(spark, path, "matches", json_lines=True)
    parsed = F.from_json("payload", "id long, status string, homeTeam struct<name string>")
    return items.select(parsed.alias("m")).select("m.id", "m.status", F.col("m.homeTeam.name").alias("home"))


def raw_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two ingestions next to each other, and a third that replaces."""
    root = work_dir(spark, "raw")
    rows = shape(spark, sf, "game_lineups")
    for _ in range(2):
        kept = sinks.write_raw(rows, root, "kept", "csv", keep_history=True)
    for _ in range(2):
        fixed = sinks.write_raw(rows, root, "fixed", "csv")
    history = spark.read.option("header", True).csv(kept)
    return history.agg(
        F.count("*").alias("kept_rows"), F.count_distinct("ingestion_ts").alias("ingestions"),
    ).withColumn("fixed_rows", spark.read.option("header", True).csv(fixed).agg(F.count("*")).scalar())


def raw_history_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of both ingestions, with their types."""
    root = work_dir(spark, "raw")
    rows = shape(spark, sf, "game_lineups")
    for _ in range(2):
        kept = sinks.write_raw(rows, root, "kept", "csv", keep_history=True)
    history = spark.read.option("header", True).csv(kept)
    return history.select(*(F.col(name).cast(kind).alias(name) for name, kind in rows.dtypes))


def csv_file_report(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per dataset and whether any file holds some; one dataset has a header only.

    A task without rows writes a header-only file, which the check rejects by itself.
    """
    root = work_dir(spark, "checked")
    for name in ("appearances", "games"):
        sinks.write_csv(shape(spark, sf, name), f"{root}/{name}")
    sinks.write_csv(shape(spark, sf, "clubs").filter("club_id < 0").coalesce(1), f"{root}/clubs")
    report = quality.check_csv_files(spark, root)
    return report.groupBy(F.regexp_extract("file_path", "([^/]+)/[^/]+$", 1).alias("dataset")).agg(
        F.sum("rows").alias("rows"), F.bool_or("valid").alias("any_valid")
    )


def json_file_report(spark: SparkSession, sf: str) -> DataFrame:
    """One folder per group of orders; one group has empty documents and one has a broken one."""
    root = work_dir(spark, "checked")
    key = F.col("o_orderkey")
    document = (
        F.when(key % 12 == 3, "{}").when(key == 5, '{"n": ').otherwise(F.to_json(F.struct("o_orderkey", "o_orderstatus")))
    )
    orders = table(spark, sf, "orders").select((key % 12).alias("part"), document.alias("value"))
    orders.repartition(12, "part").write.partitionBy("part").text(root)
    report = quality.check_json_files(spark, root, lines=True)
    return report.groupBy(F.regexp_extract("file_path", "part=([0-9]+)/", 1).cast("bigint").alias("part")).agg(
        F.sum("rows").alias("rows"), F.bool_and("valid").alias("valid"), F.max("reason").alias("reason")
    )


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events seen as runs of an ingest."""
    events = table(spark, sf, "events")
    return events.select(
        F.col("event_id").cast("string").alias("ingestion_id"),
        F.lit("csv_dump").alias("source"),
        "event_type",
        F.concat(F.lit("e"), F.col("user_id") % 5).alias("endpoint"),
        F.col("ts").alias("execution_timestamp"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("user_id").alias("rows_fetched"),
        F.concat(F.lit("v"), F.floor(F.col("event_id") / 1500)).alias("schema_hash"),
        F.lit(None).cast("string").alias("metadata"),
    )


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.run_summary(audit_log(spark, sf).withColumn("source", F.col("event_type")))


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    return audit.schema_drift(audit_log(spark, sf)).drop("execution_timestamp")


def key_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_report(shape(spark, sf, "game_lineups"), ["game_id", "player_id"], ["team_captain"])


def cast_rejects(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType([T.StructField("date_of_birth", T.DateType()), T.StructField("first_name", T.IntegerType())])
    return quality.cast_rejects(shape(spark, sf, "players"), target, ["player_id"])


def domain_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.domain_check(shape(spark, sf, "players"), "position", ["Attack", "Midfield"], "WARNING")


def land_dumps(spark: SparkSession, sf: str, root: str) -> None:
    """Gzipped dumps, as they would be landed."""
    for name in RAW_CSV:
        shape(spark, sf, name).write.options(header=True, **sinks.GZIP).csv(f"{root}/csv/{name}")


def land_documents(spark: SparkSession, sf: str, root: str) -> None:
    """Endpoint documents, one per line."""
    documents = {
        "competition": shape(spark, sf, "competitions"),
        "matches": match_documents(spark, sf),
        "standings": standing_items(spark, sf).select(F.array("item").alias("standings")),
        "teams": shape(spark, sf, "clubs").select(F.array(F.struct("club_id", "name")).alias("teams")),
        "scorers": shape(spark, sf, "players").select(F.array(F.struct("player_id", "name")).alias("scorers")),
    }
    for name, df in documents.items():
        sinks.write_json(df, f"{root}/json/{name}")


def dumps_ingested(spark: SparkSession, sf: str) -> str:
    root = work_dir(spark, "landing")
    land_dumps(spark, sf, root)
    ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit")
    return root


def ingested_dumps(spark: SparkSession, sf: str) -> DataFrame:
    root = dumps_ingested(spark, sf)
    return audit.read_audit(spark, f"{root}/audit").select(
        "endpoint", "status", "rows_written",
        F.col("metadata")["rows_before_filter"].cast("bigint").alias("rows_before"),
    )


def ingested_transfers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the either-side cascade step, read back from the raw layer."""
    root = dumps_ingested(spark, sf)
    raw = readers.read_csv(spark, f"{root}/raw/csv_dump/transfers", RAW_CSV["transfers"])
    return raw.select("player_id", "from_club_id", "to_club_id", "transfer_date", "transfer_fee")


def ingested_json(spark: SparkSession, sf: str) -> DataFrame:
    root = work_dir(spark, "landing")
    land_documents(spark, sf, root)
    ingest.ingest_json(spark, f"{root}/json", f"{root}/raw", f"{root}/audit", json_lines=True)
    return audit.read_audit(spark, f"{root}/audit").select("endpoint", "status", "rows_fetched")


def refreshed(spark: SparkSession, sf: str) -> str:
    """Landed files through every layer to gold."""
    root = work_dir(spark, "landing")
    land_dumps(spark, sf, root)
    land_documents(spark, sf, root)
    ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit", competitions=None)
    ingest.ingest_json(spark, f"{root}/json", f"{root}/raw", f"{root}/audit", json_lines=True)
    kinds = {"csv_dump": "csv", "json_api": "json_lines"}
    quality.validate_layer(spark, f"{root}/raw", f"{root}/validated", kinds).collect()
    sinks.write_csv(shape(spark, sf, "defense"), f"{root}/validated/defense")
    transform_layer(spark, f"{root}/validated", f"{root}/gold", AS_OF)
    return root


def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Landing, ingest, validation, transformation and load; the report of the load."""
    root = refreshed(spark, sf)
    report = star.load_star(spark, f"{root}/gold", f"{root}/star")
    return report.select("table_name", "status", "rows_read", "rows_written", "duplicates_removed")


def served_report(spark: SparkSession, sf: str) -> DataFrame:
    """A report on the loaded star schema instead of on lazily derived tables."""
    root = refreshed(spark, sf)
    star.load_star(spark, f"{root}/gold", f"{root}/star")
    tables = star.open_star(spark, f"{root}/star", register=True)
    return reports.undervalued_by_impact(scout_view(tables["dim_players"], tables["dim_clubs"]))


def published_valuations(spark: SparkSession, sf: str) -> DataFrame:
    """The valuations of a star that was loaded twice: first without them, then with all; read through the pointer."""
    root = work_dir(spark, "publish")
    sinks.write_parquet(gold_registry.valuations(spark, sf), f"{root}/gold/valuations")
    star.load_star(spark, f"{root}/none", f"{root}/star")
    star.load_star(spark, f"{root}/gold", f"{root}/star")
    return star.open_star(spark, f"{root}/star")["fact_valuations"]


def _star_line(gold: str, name: str) -> str:
    keys = STAR_KEYS.get(name)
    kept = f"(SELECT count(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {gold}))" if keys else "count(*)"
    return f"""SELECT '{name}' AS table_name, 'loaded' AS status, count(*) AS rows_read, {kept} AS rows_written,
               count(*) - {kept} AS duplicates_removed FROM {gold}"""


CASCADED = {
    "k_competitions": "SELECT * FROM competitions WHERE competition_id IN ('GB1', 'ES1', 'IT1', 'L1', 'FR1', 'BRA1')",
    "k_clubs": "SELECT * FROM clubs WHERE domestic_competition_id IN ('GB1', 'ES1', 'IT1', 'L1', 'FR1', 'BRA1')",
    "k_players": "SELECT * FROM players WHERE current_club_id IN (SELECT club_id FROM k_clubs)",
    "k_transfers": """SELECT * FROM transfers WHERE from_club_id IN (SELECT club_id FROM k_clubs)
                      OR to_club_id IN (SELECT club_id FROM k_clubs)""",
    "k_player_valuations": "SELECT * FROM player_valuations WHERE player_id IN (SELECT player_id FROM k_players)",
    "k_appearances": "SELECT * FROM appearances WHERE player_id IN (SELECT player_id FROM k_players)",
    "k_games": """SELECT * FROM games WHERE home_club_id IN (SELECT club_id FROM k_clubs)
                  OR away_club_id IN (SELECT club_id FROM k_clubs)""",
    "k_game_lineups": "SELECT * FROM game_lineups WHERE club_id IN (SELECT club_id FROM k_clubs)",
}
INGESTED = " UNION ALL ".join(
    f"""SELECT '{n}' AS endpoint, 'success' AS status, count(*) AS rows_written,
        (SELECT count(*) FROM {n}) AS rows_before FROM k_{n}""" for n in RAW_CSV
)
INGESTED_JSON = " UNION ALL ".join(
    f"SELECT '{endpoint}' AS endpoint, 'success' AS status, count(*) AS rows_fetched FROM {rows}"
    for endpoint, rows in {
        "competition": "competitions", "matches": "match_rows", "teams": "clubs", "scorers": "players",
        "standings": "standing_groups",
    }.items()
)
_REST = ", ".join(f"{c} NULLS FIRST" for c in GOLD["valuations"].names if c not in STAR_KEYS["fact_valuations"])
PUBLISHED = f"""SELECT * FROM g_valuations
    QUALIFY row_number() OVER (PARTITION BY {', '.join(STAR_KEYS["fact_valuations"])} ORDER BY {_REST}) = 1"""
MATCH_FIELDS = gold_registry.QUERIES["match_fields"].oracle

WHOLE_GAMES = oracle("SELECT * REPLACE (CAST(date AS DATE) AS date) FROM games")

QUERIES = {
    "csv_round_trip": Query(csv_round_trip, oracle("SELECT * FROM appearances")),
    "gzip_round_trip": Query(gzip_round_trip, oracle("SELECT * FROM player_valuations")),
    "parquet_round_trip": Query(parquet_round_trip, WHOLE_GAMES),
    "parquet_whole_table": Query(parquet_round_trip, WHOLE_GAMES),
    "wrapped_json": Query(wrapped_json, MATCH_FIELDS),
    "bare_json": Query(bare_json, MATCH_FIELDS),
    "league_payloads": Query(
        league_payloads, oracle("SELECT match_id AS id, status, 'TEAM ' || home_id AS home FROM match_rows")
    ),
    "raw_history": Query(
        raw_history,
        oracle("""SELECT 2 * count(*) AS kept_rows, CAST(2 AS BIGINT) AS ingestions, count(*) AS fixed_rows
                  FROM game_lineups"""),
    ),
    "raw_history_rows": Query(
        raw_history_rows, oracle("SELECT * FROM game_lineups UNION ALL SELECT * FROM game_lineups")
    ),
    "csv_file_report": Query(
        csv_file_report,
        oracle("""SELECT 'appearances' AS dataset, count(*) AS rows, true AS any_valid FROM appearances
                  UNION ALL SELECT 'games', count(*), true FROM games
                  UNION ALL SELECT 'clubs', count(*), false FROM clubs WHERE club_id < 0"""),
    ),
    "json_file_report": Query(
        json_file_report,
        """SELECT o_orderkey % 12 AS part, count(*) FILTER (o_orderkey % 12 <> 3 AND o_orderkey <> 5) AS rows,
             o_orderkey % 12 NOT IN (3, 5) AS valid,
             CASE o_orderkey % 12 WHEN 3 THEN 'empty' WHEN 5 THEN 'broken' END AS reason
           FROM orders GROUP BY ALL""",
    ),
    "run_summary": Query(
        run_summary,
        """SELECT event_type AS source, count(*) FILTER (event_type <> 'error') AS endpoints_ok,
             count(*) AS endpoints_total, CAST(sum(user_id) AS BIGINT) AS total_rows
           FROM events GROUP BY event_type""",
    ),
    "schema_drift": Query(
        schema_drift,
        """SELECT 'csv_dump' AS source, endpoint, CAST(event_id AS VARCHAR) AS ingestion_id, previous_hash, schema_hash
           FROM (SELECT *, lag(schema_hash) OVER (PARTITION BY endpoint ORDER BY ts, CAST(event_id AS VARCHAR))
                   AS previous_hash
                 FROM (SELECT *, 'e' || user_id % 5 AS endpoint, 'v' || event_id // 1500 AS schema_hash
                       FROM events WHERE event_type <> 'error'))
           WHERE previous_hash <> schema_hash""",
    ),
    "key_report": Query(
        key_report,
        oracle("""SELECT count(*) AS rows,
                    count(*) - (SELECT count(*) FROM (SELECT DISTINCT game_id, player_id FROM game_lineups))
                      AS duplicate_rows,
                    count(*) FILTER (game_id IS NULL) AS null_game_id,
                    count(*) FILTER (player_id IS NULL) AS null_player_id,
                    count(*) FILTER (team_captain IS NULL) AS null_team_captain FROM game_lineups"""),
    ),
    "cast_rejects": Query(
        cast_rejects,
        oracle("""SELECT player_id, 'first_name' AS "column", 'int' AS kind, first_name AS value FROM players
                  UNION ALL SELECT player_id, 'date_of_birth', 'date', date_of_birth FROM players
                  WHERE TRY_CAST(date_of_birth AS DATE) IS NULL"""),
    ),
    "domain_check": Query(
        domain_check,
        oracle("""SELECT position AS value, count(*) AS violations, 'WARNING' AS severity FROM players
                  WHERE position NOT IN ('Attack', 'Midfield') GROUP BY position"""),
    ),
    "ingested_dumps": Query(ingested_dumps, oracle(INGESTED, **CASCADED)),
    "ingested_transfers": Query(
        ingested_transfers,
        oracle(
            """SELECT player_id, from_club_id, to_club_id, transfer_date, CAST(transfer_fee AS DOUBLE) AS transfer_fee
               FROM k_transfers""",
            **CASCADED,
        ),
    ),
    "ingested_json": Query(
        ingested_json, oracle(INGESTED_JSON, standing_groups="SELECT DISTINCT doc FROM table_rows")
    ),
    "full_refresh": Query(
        full_refresh,
        oracle(" UNION ALL ".join(_star_line(f"g_{g}", s) for g, s in STAR_TABLES.items())),
    ),
    "published_valuations": Query(published_valuations, oracle(PUBLISHED)),
    "served_report": Query(served_report, oracle(IMPACT)),
}
