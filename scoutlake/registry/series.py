"""Per-entity series on orders, line items and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake.operators.aggregates import first_last
from scoutlake.operators.windows import latest_per_key, with_change, with_previous
from scoutlake.registry import Query
from scoutlake.registry.oracle import oracle, rounded
from scoutlake.registry.shapes import shape, table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice"
    )


def previous_price(spark: SparkSession, sf: str) -> DataFrame:
    return with_previous(_orders(spark, sf), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", "previous")


def previous_price_split(spark: SparkSession, sf: str) -> DataFrame:
    """The same result from so many ranges that many customers are cut."""
    order = ["o_orderdate", "o_orderkey"]
    return with_previous(_orders(spark, sf), "o_custkey", order, "o_totalprice", "previous", parts=61)


def previous_event_value(spark: SparkSession, sf: str) -> DataFrame:
    """A handful of event types hold all events, so every one of them is cut into ranges."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    return with_previous(events, "event_type", ["ts", "event_id"], "value", "previous", parts=37).drop("ts")


def price_change(spark: SparkSession, sf: str) -> DataFrame:
    return with_change(
        _orders(spark, sf), "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", "previous", "change_pct"
    )


def latest_order(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(_orders(spark, sf), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])


def valuation_ends(spark: SparkSession, sf: str) -> DataFrame:
    raw = shape(spark, sf, "player_valuations")
    return first_last(raw, "player_id", "date", "market_value_in_eur")


def club_valuation_ends(spark: SparkSession, sf: str) -> DataFrame:
    """With a label that varies inside an entity: only variants at an end of the history give a row."""
    raw = shape(spark, sf, "player_valuations")
    return first_last(raw, "player_id", "date", "market_value_in_eur", ["current_club_name"]).select(
        "player_id", "current_club_name", "first_value", "last_value"
    )


LAG = """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice,
      lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous
    FROM orders"""

QUERIES = {
    "previous_price": Query(previous_price, LAG),
    "previous_price_split": Query(previous_price_split, LAG),
    "previous_event_value": Query(
        previous_event_value,
        """SELECT event_id, event_type, value,
             lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events""",
    ),
    "price_change": Query(
        price_change,
        f"SELECT *, {rounded('(o_totalprice - previous) / previous * 100', 2)} AS change_pct FROM ({LAG})",
    ),
    "latest_order_per_customer": Query(
        latest_order,
        """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
           QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    ),
    "first_and_last_valuation": Query(
        valuation_ends,
        oracle(
            """SELECT v.player_id, min(e.lo) AS first_date, min(e.hi) AS last_date,
                 min(CASE WHEN v.date = e.lo THEN v.market_value_in_eur END) AS first_value,
                 max(CASE WHEN v.date = e.hi THEN v.market_value_in_eur END) AS last_value
               FROM player_valuations v
               JOIN (SELECT player_id, min(date) AS lo, max(date) AS hi FROM player_valuations GROUP BY 1) e
                 ON e.player_id = v.player_id AND (v.date = e.lo OR v.date = e.hi)
               GROUP BY v.player_id"""
        ),
    ),
    "first_and_last_valuation_by_club": Query(
        club_valuation_ends,
        oracle(
            """SELECT v.player_id, v.current_club_name,
                 min(CASE WHEN v.date = e.lo THEN v.market_value_in_eur END) AS first_value,
                 max(CASE WHEN v.date = e.hi THEN v.market_value_in_eur END) AS last_value
               FROM player_valuations v
               JOIN (SELECT player_id, min(date) AS lo, max(date) AS hi FROM player_valuations GROUP BY 1) e
                 ON e.player_id = v.player_id AND (v.date = e.lo OR v.date = e.hi)
               GROUP BY v.player_id, v.current_club_name"""
        ),
    ),
}
