"""Runs registered queries and their oracles and reports differences.

    python tools/compare.py [sf_dir] [name ...]

SHUFFLE_PARTITIONS sets spark.sql.shuffle.partitions (default 8).
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from scoutlake.registry import all_queries  # noqa: E402
from scoutlake.session import build_session  # noqa: E402

KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def value_key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, repr(value + 0.0))
    return (1, str(value))


def compare(spark, con, sf_dir, name, query):
    started = time.time()
    df = query.run(spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(tuple(value_key(v) for v in r) for r in df.select(*(F.col(f"`{c}`") for c in columns)).collect())
    spent = time.time() - started
    if not query.oracle:
        return f"rows only ({len(rows)})", spent
    relation = con.sql(query.oracle)
    kinds = dict(zip(relation.columns, (str(t) for t in relation.types)))
    if sorted(kinds) != columns:
        return f"COLUMNS differ: {sorted(set(kinds) ^ set(columns))}", spent
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(tuple(value_key(v) for v in r) for r in relation.select(listed).fetchall())
    notes = [
        f"{c}: {k} vs {KINDS.get(kinds[c], kinds[c])}" for c, k in df.dtypes if KINDS.get(kinds[c], kinds[c]) != k
    ]
    suffix = f" TYPES {notes}" if notes else ""
    if rows == expected:
        return f"ok ({len(rows)}){suffix}" + ("" if rows else " EMPTY"), spent
    if len(rows) != len(expected):
        return f"ROWS differ: {len(rows)} vs {len(expected)}{suffix}", spent
    for got, want in zip(rows, expected):
        if got != want:
            cells = [(c, g[1], w[1]) for c, g, w in zip(columns, got, want) if g != w]
            break
    wrong = sum(g != w for g, w in zip(rows, expected))
    return f"VALUES differ in {wrong} of {len(rows)}: {cells[:4]}{suffix}", spent


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=os.environ.get("SHUFFLE_PARTITIONS", "8"), spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    bad = 0
    for name, query in all_queries().items():
        if args and not any(a in name for a in args):
            continue
        try:
            verdict, spent = compare(spark, con, sf_dir, name, query)
        except Exception as error:
            verdict, spent = f"ERROR {type(error).__name__}: {str(error)[:1500]}", 0
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{spent:6.1f}s  {name}: {verdict}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
