import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from scoutlake.registry import all_queries
from tools.compare import compare

SF_DIR = "/root/testdata/sf0.001"
# The longest ones run in the comparison tool; their parts are covered here and in the source tests.
LONG = {"full_refresh", "served_report", "ingested_transfers", "api_row_counts", "player_model_importances"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[:2] == ["player_id", "name"]


@pytest.mark.parametrize("name", sorted(set(all_queries()) - LONG))
def test_query_equals_its_oracle(spark, duck, name):
    verdict, _ = compare(spark, duck, SF_DIR, name, all_queries()[name])
    assert verdict.startswith(("ok", "rows only")) and "TYPES" not in verdict, verdict
