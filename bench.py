"""Seconds per headline query; prints one JSON line.

    BENCH_SF_DIR  tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
    BENCH_RUNS    measured runs after one warm-up (default 3); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scoutlake.registry import all_queries  # noqa: E402
from scoutlake.session import build_session  # noqa: E402

HEADLINE = (
    "gold_players", "gold_clubs", "gold_valuations", "gold_transfers", "gold_games", "gold_matches", "gold_standings",
    "scout_view", "undervalued_gems", "biggest_appreciation", "best_transfer_returns", "expiring_contracts",
    "top_selling_clubs", "league_stats", "rising_now", "undervalued_by_impact", "star_row_counts",
    "semi_cascade", "club_in_set_either_side", "deduplicated_lines", "previous_price", "price_change",
    "first_and_last_valuation", "latest_order_per_customer", "built_query", "team_strength", "game_features",
    "mapped_part_names",
)


def seconds(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, wanted = all_queries(), sys.argv[1:] or HEADLINE
    took = {}
    for name in wanted:
        seconds(known[name], spark, sf_dir)
        took[name] = round(statistics.median(seconds(known[name], spark, sf_dir) for _ in range(runs)), 3)
    total = round(sum(took.values()), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": took, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
