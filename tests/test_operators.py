import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F, types as T

from scoutlake.operators import aggregates as agg, relational as rel
from scoutlake.operators.query_builder import Filter, QuerySpec, build_query
from scoutlake.operators.query_text import Refused
from scoutlake.operators.windows import latest_per_key, with_change, with_previous


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def history(spark, seed=7, n=400):
    rng = random.Random(seed)
    base = dt.date(2024, 1, 1)
    data = []
    for i in range(n):
        # Entity "hot" holds a third of the rows.
        entity = "hot" if rng.random() < 0.34 else rng.choice([None, "0", *(f"p{k}" for k in range(40))])
        day = None if rng.random() < 0.03 else base + dt.timedelta(days=rng.randint(0, 12))
        value = None if rng.random() < 0.1 else float(rng.randint(0, 50))
        data.append((entity, day, i, value))
    return data, spark.createDataFrame(data, "e string, d date, i long, v double")


def brute_previous(data):
    expected = {}
    by_entity = {}
    for row in data:
        by_entity.setdefault(row[0], []).append(row)
    for rows in by_entity.values():
        rows.sort(key=lambda r: (r[1] is not None, r[1] or dt.date.min, r[2]))
        for before, row in zip([None, *rows], rows):
            expected[row[2]] = before[3] if before else None
    return expected


@pytest.mark.parametrize("parts", [None, 1, 7, 97])
def test_previous_value_is_the_same_however_histories_are_cut(spark, parts):
    data, df = history(spark)
    got = {r.i: r.prev_value for r in with_previous(df, "e", ["d", "i"], "v", parts=parts).collect()}
    assert got == brute_previous(data)


def test_previous_value_in_text_times_and_small_batches(spark):
    data, df = history(spark, seed=3)
    text = df.withColumns({"d": F.col("d").cast("string"), "prev_value": F.lit("taken"), "_entity": F.lit(1)})
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        found = with_previous(text, "e", ["d", "i"], "v", parts=5)
        assert found.columns == ["e", "d", "i", "v", "_entity", "prev_value"]
        assert {r.i: r.prev_value for r in found.collect()} == brute_previous(data)
    finally:
        spark.conf.set(key, before)


def test_previous_value_on_timestamps(spark):
    data, df = history(spark, seed=3)
    stamped = df.withColumn("d", F.col("d").cast("timestamp") + F.make_interval(secs=F.col("i") % 7))
    cut, whole = (with_previous(stamped, "e", ["d", "i"], "v", parts=n) for n in (13, 1))
    assert sorted(cut.collect(), key=lambda r: r.i) == sorted(whole.collect(), key=lambda r: r.i)


def test_previous_value_of_one_entity_on_one_day(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", day, i, float(i)) for i in range(500)], "e string, d date, i long, v double")
    cut = with_previous(df, "e", ["d", "i"], "v", parts=16)
    assert {r.i: r.prev_value for r in cut.collect()} == {i: float(i - 1) if i else None for i in range(500)}
    # Equal rows but for a column that is no part of the order, and rows that are wholly equal.
    same = spark.createDataFrame([("a", day, 1.0, i % 40) for i in range(200)], "e string, d date, v double, x int")
    found = with_previous(same, "e", ["d"], "v", parts=8).collect()
    assert len(found) == 200 and sum(r.prev_value is None for r in found) == 1
    assert with_previous(df.limit(0), "e", ["d", "i"], "v").count() == 0


def test_previous_value_scans_the_fact_once(spark, tmp_path):
    _, df = history(spark)
    df.write.parquet(f"{tmp_path}/fact")
    text = plan(with_previous(spark.read.parquet(f"{tmp_path}/fact"), "e", ["d", "i"], "v"))
    assert f"{tmp_path}/fact" not in text and "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 1


def test_equal_dates_are_ordered_by_the_tie_breaker(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("a", day, 2, 20.0), ("a", day, 1, 10.0)], "e string, d date, i int, v double")
    got = {r.i: (r.prev_value, r.value_change_pct) for r in with_change(df, "e", ["d", "i"], "v").collect()}
    assert got == {1: (None, None), 2: (10.0, 100.0)}


def test_latest_per_key_limits_groups_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("b", 1, 9)], "k string, d int, v int")
    latest = latest_per_key(df, ["k"], [F.desc("d")])
    assert plan(latest).count("WindowGroupLimit") == 2
    assert rows(latest) == [("a", 2, 4), ("b", 1, 9)]


def test_first_last_takes_lowest_first_and_highest_last_on_ties(spark, rows):
    data = [
        ("a", "2020", 5.0), ("a", "2020", 3.0), ("a", "2020", None), ("a", "2022", 7.0), ("a", "2022", 9.0),
        ("a", None, 100.0), ("b", "2021", None), ("c", None, 1.0),
    ]
    df = spark.createDataFrame(data, "e string, d string, v double")
    got = rows(agg.first_last(df, "e", "d", "v"))
    assert got == [("a", "2020", "2022", 3.0, 9.0), ("b", "2021", "2021", None, None)]


def test_first_last_needs_no_join_and_shuffles_partial_results(spark):
    _, df = history(spark)
    text = plan(agg.first_last(df, "e", "d", "v"))
    assert "Join" not in text and "partial_min" in text and text.count("Exchange hashpartitioning") == 1


def test_lineup_counts(spark, rows):
    data = [(1, 7, "starting_lineup", 1), (1, 7, "starting_lineup", None), (1, 7, "substitutes", 0), (1, 8, "other", 0)]
    df = spark.createDataFrame(data, "game_id long, club_id long, type string, team_captain int")
    assert rows(agg.lineup_by_club(df)) == [(1, 7, 2, 1, 1), (1, 8, 0, 0, 0)]


def test_distinct_counts_ignore_nulls(spark, rows):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("g", None), ("h", None)], "g string, p int")
    assert rows(agg.distinct_per_key(df, "g", "p", "n")) == [("g", 1), ("h", 0)]
    assert rows(agg.distinct_per_key(df, "g", "p", "n", approximate=True)) == [("g", 1), ("h", 0)]


def test_dedup_and_its_report(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (None, "x"), (None, "y")], "k int, v string")
    assert rows(agg.dedup_by_key(df, ["k"], [F.col("v")])) == [(None, "x"), (1, "a"), (2, None)]
    assert rows(agg.dropped_by_dedup(df, ["k"])) == [(5, 3, 2)]
    assert rows(agg.dropped_by_dedup(df.limit(0), ["k"])) == [(0, 0, 0)]


def test_median_and_means(spark, rows):
    df = spark.createDataFrame([(1, 180.0), (2, 190.0), (3, 190.0), (4, 170.0), (5, None)], "i int, h double")
    assert rows(agg.exact_median(df, "h")) == [(185.0,)]
    assert rows(agg.fill_median(df, "h"))[-1] == (5, 185.0)
    assert {r.m for r in agg.with_means(df, {"m": "h"}).collect()} == {182.5}
    assert "Cartesian" not in plan(agg.with_means(df, {"m": "h"})) and "NestedLoop" not in plan(agg.fill_median(df, "h"))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1_000, 1_001])
def test_median_of_a_continuous_column(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.gauss(0, 1), 0.5, -3.0]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(5)
    found = agg.exact_median(df, "v")
    assert found.first().median == (pytest.approx(statistics.median(values), abs=0) if values else None)
    # Only the ranges in the middle are counted through.
    assert "SortMergeJoin" not in plan(found)


def test_median_of_whole_numbers_and_decimals(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (2,), (9,)], "v int")
    assert rows(agg.exact_median(df, "v")) == [(2.0,)]
    assert rows(agg.exact_median(df.select(F.col("v").cast("decimal(9,2)").alias("v")), "v")) == [(2.0,)]


def test_union_counts(spark, rows):
    assert rows(agg.union_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rel.select_existing(df, ["b", "zz", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="zz"):
        rel.select_existing(df, ["zz"], strict=True)
    assert rel.with_typed_nulls(df, {"a": "string", "c": "double"}).dtypes == [
        ("a", "int"), ("b", "string"), ("c", "double")
    ]
    schema = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("c", T.DateType())])
    assert [tuple(r) for r in rel.conform(df, schema).collect()] == [(None, None)]


def test_semi_filters(spark, rows):
    facts = spark.createDataFrame([(1, 9), (2, 1), (3, 8), (None, 7)], "a int, b int")
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(rel.semi_filter(facts, keys, "a", "k")) == [(1, 9), (2, 1)]
    assert rel.semi_filter(facts, None, "a").count() == 4
    assert rel.semi_filter(facts, None, "a", on_missing="drop").count() == 0
    either = rel.semi_any(facts, keys, ["a", "b"], "k")
    assert rows(either) == [(1, 9), (2, 1)]
    assert "NestedLoop" not in plan(either) and "Cartesian" not in plan(either)


def test_a_transfer_with_one_known_club_is_kept(spark, rows):
    facts = spark.createDataFrame([(1, 9), (9, 1), (9, 9), (1, 1)], "a int, b int")
    keys = spark.createDataFrame([(1,)], "k int")
    assert rows(rel.semi_any(facts, keys, ["a", "b"], "k")) == [(1, 1), (1, 9), (9, 1)]


def test_role_join(spark, rows):
    games = spark.createDataFrame([(10, 1, 2), (11, 2, 3)], "g int, home int, away int")
    clubs = spark.createDataFrame([(1, 0.5), (2, 1.5)], "club int, s double")
    roles = {"home": {"hs": "s"}, "away": {"as": "s"}}
    assert rows(rel.role_join(games, clubs, "club", roles), "g", "hs", "as") == [(10, 0.5, 1.5)]
    assert rows(rel.role_join(games, clubs, "club", roles, "left"), "g", "hs", "as") == [(10, 0.5, 1.5), (11, 1.5, None)]


def test_explode_path_drops_empty_arrays(spark, rows):
    df = spark.createDataFrame(
        [([("T", [1, 2]), ("H", [3])],), ([("T", [])],), (None,)], "s array<struct<t: string, x: array<int>>>"
    )
    got = rel.explode_path(df, "s.x", where={0: F.col("item.t") == "T"})
    assert rows(got) == [(1,), (2,)]


def test_top_n_counts_nulls_as_lowest(spark, rows):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (4, 7.0)], "i int, v double")
    assert [r.i for r in rel.top_n(df, "v", 3, tie_break=["i"]).collect()] == [3, 4, 1]
    assert [r.i for r in rel.top_n(df, "v", 2, descending=False, tie_break=["i"]).collect()] == [2, 1]
    assert "TakeOrderedAndProject" in plan(rel.top_n(df, "v", 3))


def test_drop_incomplete_and_lookup(spark, rows):
    df = spark.createDataFrame([("O'Neil", 1), ("x", None)], "n string, v int")
    assert rows(rel.drop_incomplete(df, ["v"])) == [("O'Neil", 1)]
    assert rows(rel.lookup(df, "n", "O'Neil")) == [("O'Neil", 1)]


def test_adhoc_reads_only(spark, rows):
    spark.range(3).createOrReplaceTempView("three")
    assert rows(rel.adhoc(spark, "WITH t AS (SELECT id FROM three) SELECT max(id) FROM t; ")) == [(2,)]
    for text in ("DROP VIEW three", "INSERT INTO three VALUES (1)", "WITH t AS (SELECT 1) INSERT INTO three SELECT * FROM t"):
        with pytest.raises(Exception):
            rel.adhoc(spark, text)
    assert spark.table("three").count() == 3
    assert rows(rel.adhoc(spark, "SELECT 'reflect(x)' AS t")) == [("reflect(x)",)]


@pytest.mark.parametrize("text", [
    "SELECT reflect('java.lang.Math', 'random')",
    "SELECT reflect/* */('java.lang.System','setProperty','x.y','z')",
    "SELECT reflect--\n('java.lang.System','setProperty','x.y','z')",
    "SELECT `java_method` ('a', 'b')", "SELECT try_reflect('a', 'b')", "SELECT `'` AS `'`, reflect('a', 'b') AS `'` FROM three",
    "SELECT * FROM csv.`/tmp/x`", "SELECT * FROM parquet./**/`/root/testdata/sf0.001/region.parquet`",
    "SELECT IDENTIFIER('reflect')('a', 'b')", "SELECT * FROM IDENTIFIER('thr' || 'ee')", "SELECT * FROM default.three",
    "SELECT * FROM nowhere", "SELECT * FROM range(10)", "SELECT * FROM read_files('/tmp')", "SELECT input_file_name() FROM three",
    "SELECT id FROM three WHERE id IN (SELECT reflect('a', 'b'))", "SELECT id FROM three ORDER BY reflect('a', 'b')",
    "WITH t AS (SELECT reflect('a', 'b')) SELECT * FROM t", "SELECT (WITH three2 AS (SELECT 1) SELECT * FROM three2), * FROM three2",
    "WITH a AS (SELECT * FROM b), b AS (SELECT 1) SELECT * FROM a", "SELECT system.builtin.reflect('a', 'b')",
    "SELECT TRANSFORM(id) USING 'cat' FROM three", "SELECT count(*) FILTER (WHERE reflect('a', 'b') = '') FROM three",
    "SELECT sum(id) OVER (ORDER BY reflect('a', 'b')) FROM three",
])
def test_adhoc_refuses_what_is_not_listed(spark, text):
    spark.range(3).createOrReplaceTempView("three")
    with pytest.raises(Refused, match="not allowed"):
        rel.adhoc(spark, text)


def test_adhoc_allows_plain_queries(spark, rows):
    spark.range(3).createOrReplaceTempView("three")
    for text, expected in (
        ("SELECT `'` FROM (SELECT id AS `'` FROM three) WHERE `'` > 1 -- reflect(", [(2,)]),
        ("SELECT max(a.id) AS m FROM three a JOIN Three b ON a.id = b.id GROUP BY a.id HAVING max(a.id) > 0 ORDER BY 1", [(1,), (2,)]),
        ("SELECT id FROM three WHERE id = (SELECT max(id) FROM three) UNION ALL SELECT 7", [(2,), (7,)]),
        ("WITH a AS (SELECT 1 AS x), b AS (SELECT x + 1 AS x FROM a) SELECT * FROM b", [(2,)]),
        ("SELECT CASE WHEN id LIKE '1' THEN CAST(id AS int) END AS x FROM three WHERE id BETWEEN 1 AND 1 LIMIT 1", [(1,)]),
        ("SELECT row_number() OVER (ORDER BY id DESC) AS x FROM three WHERE EXISTS (SELECT 1 FROM three)", [(1,), (2,), (3,)]),
        ("SELECT * FROM VALUES (1), (2) AS v(x)", [(1,), (2,)]),
    ):
        assert rows(rel.adhoc(spark, text)) == expected


def test_query_builder(spark, rows):
    df = spark.createDataFrame(
        [("O'Neil", 20, 1.5), ("Ana%", 30, 2.5), ("Bob", None, 3.5)], "name string, age int, score double"
    )

    def names(*filters, **spec):
        return [r.name for r in build_query(df, QuerySpec(filters=filters, order_by=("name",), **spec)).collect()]

    assert build_query(df, QuerySpec()).columns == df.columns
    assert names(Filter("name", "=", "O'Neil")) == ["O'Neil"]
    assert names(Filter("name", "LIKE", "%")) == ["Ana%"]
    assert names(Filter("age", ">", "20"), Filter("score", "<=", 2.5)) == ["Ana%"]
    assert names(Filter("name", ">", "B")) == ["Bob", "O'Neil"]
    assert names(Filter("age", "=", ""), Filter("", "=", "x")) == ["Ana%", "Bob", "O'Neil"]
    assert names(limit=1) == ["Ana%"]
    assert build_query(df, QuerySpec(columns=("score",), filters=(Filter("age", "!=", 30),))).columns == ["score"]
    with pytest.raises(ValueError, match="no_such"):
        build_query(df, QuerySpec(columns=("no_such",)))
    for value in ("not a number", "1e99", object):
        with pytest.raises(Exception if value is object else ValueError):
            names(Filter("age", "=", value))
    with pytest.raises(ValueError, match="operator"):
        build_query(df, QuerySpec(filters=(Filter("age", "; DROP", 1),)))


def test_strength_needs_enough_games_in_both_roles(spark, rows):
    data = [("a", "A", "b", "B", 2, 1)] * 2 + [("b", "B", "a", "A", 0, 3)] * 2 + [("c", "C", "a", "A", 1, 1)]
    games = spark.createDataFrame(
        data, "home_club_id string, home_club_name string, away_club_id string, away_club_name string, "
        "home_club_goals int, away_club_goals int",
    )
    got = rows(agg.home_away_strength(games, 2), "club_id", "avg_goals_scored_home", "avg_goals_scored_away", "overall_attack")
    assert got == [("a", 2.0, (3 + 3 + 1) / 3, (2.0 + 7 / 3) / 2), ("b", 0.0, 1.0, 0.5)]
