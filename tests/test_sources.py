import gzip
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from scoutlake.contracts import MATCH_ITEM, RAW_CSV
from scoutlake.operators import windows
from scoutlake.plans.gold import match_rows
from scoutlake.plans.transform import transform_layer
from scoutlake.session import work_dir
from scoutlake.sources import audit, ingest, quality, readers, sinks, star, versions

MATCHES = [
    {"id": 1, "matchday": 3, "utcDate": "2026-01-28T22:00:00Z", "homeTeam": {"name": "A"}, "score": {"fullTime": {"home": 2}}},
    {"id": 2, "awayTeam": {"name": "B"}},
]


def put(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_scan(spark, tmp_path, rows):
    text = 'player_id,note,goals,assists\n1,"a, ""b""",2.0,x\n2,,3,\n'
    path = put(tmp_path / "a.csv", text)
    schema = RAW_CSV["appearances"]
    assert rows(readers.read_csv(spark, path, schema)) == [(1, 2, None), (2, 3, None)]
    assert rows(readers.read_csv(spark, path), "note") == [(None,), ('a, "b"',)]
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write(text)
    zipped = readers.read_csv(spark, str(tmp_path / "b.csv.gz"), schema, min_partitions=3)
    assert zipped.rdd.getNumPartitions() == 3 and zipped.count() == 2


@pytest.mark.parametrize("document", [{"matches": MATCHES}, MATCHES])
def test_json_layouts(spark, tmp_path, document):
    path = put(tmp_path / "m.json", json.dumps(document, indent=2))
    items = readers.read_wrapped_json(spark, path, "matches", MATCH_ITEM)
    got = sorted((r.match_id, r.matchday, r.home_team, r.away_team, r.home_score) for r in match_rows(items).collect())
    assert got == [(1, 3, "A", None, 2), (2, None, None, "B", None)]


@pytest.mark.parametrize("document", [{}, {"matches": []}, {"matches": None}, {"count": 3}, []])
def test_json_without_items(spark, tmp_path, document):
    path = put(tmp_path / "m.json", json.dumps(document))
    assert readers.read_wrapped_json(spark, path, "matches", MATCH_ITEM).count() == 0


def test_payloads_of_a_directory(spark, tmp_path):
    put(tmp_path / "t" / "a.json", json.dumps({"teams": [{"id": 1, "x": [1, 2]}, {"id": 2}]}, indent=1))
    put(tmp_path / "t" / "b.json", json.dumps({"teams": [{"id": 3}]}))
    put(tmp_path / "t" / "c.json", json.dumps({"other": 1}))
    got = readers.read_payloads(spark, str(tmp_path / "t"), "teams").collect()
    assert sorted(json.loads(r.payload)["id"] for r in got) == [1, 2, 3]
    assert {Path(r.source_file).name for r in got} == {"a.json", "b.json"}
    whole = readers.read_payloads(spark, str(tmp_path / "t"), None).collect()
    assert len(whole) == 3


def test_sinks_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'a "q", b', None), (2, None, 1.5)], "i int, s string, v double")
    sinks.write_json(df, str(tmp_path / "j"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "j"))) == rows(df)
    sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), df.schema)) == rows(df)
    sinks.write_parquet(df, str(tmp_path / "p"), sort_by=["i"])
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert rows(readers.read_parquet(spark, str(tmp_path / "p"))) == rows(df)


def test_csv_keeps_text(spark, tmp_path, rows):
    texts = [(1, "  padded  "), (2, ""), (3, None), (4, 'say "hi", ok'), (5, "two\nlines"), (6, "\\")]
    df = spark.createDataFrame(texts, "i int, s string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=True)) == rows(df)
    kept = sinks.write_raw(df.filter("i <> 5"), str(tmp_path), "kept", "csv", keep_history=True, stamp="s")
    assert rows(readers.read_csv(spark, f"{kept}/ingestion_ts=s", df.schema)) == rows(df.filter("i <> 5"))


def test_promotion_matches_columns_by_name(spark, tmp_path, rows):
    put(tmp_path / "raw/players/a.csv", "a,b\n1,one\n")
    put(tmp_path / "raw/players/b.csv", 'b,"a"\ntwo,2\n"th,ree",3\n')
    put(tmp_path / "raw/players/other.csv", "a,c\n4,four\n")
    put(tmp_path / "raw/games/g.csv", "a,c\n5,five\n")
    report = quality.check_csv_files(spark, f"{tmp_path}/raw")
    assert {Path(r.file_path).name: (r.valid, r.reason, r.rows) for r in report.collect()} == {
        "a.csv": (True, None, 1), "b.csv": (True, None, 2), "other.csv": (False, "header", 1), "g.csv": (True, None, 1)
    }
    assert quality.promote(spark, report, f"{tmp_path}/raw", f"{tmp_path}/validated", "csv") == 3
    promoted = readers.read_csv(spark, f"{tmp_path}/validated/players")
    assert rows(promoted, "a", "b") == [("1", "one"), ("2", "two"), ("3", "th,ree")]
    assert rows(readers.read_csv(spark, f"{tmp_path}/validated/games")) == [("5", "five")]


def test_a_bad_file_or_source_does_not_stop_the_next(spark, tmp_path, monkeypatch):
    put(tmp_path / "raw/one/players/a.csv", "a,b\n1,one\n")
    put(tmp_path / "raw/one/players/b.csv", "z,b\ntwo,2\n")
    put(tmp_path / "raw/two/players/a.csv", "a,b\n1,one\n")
    raw, validated = f"{tmp_path}/raw", f"{tmp_path}/validated"
    found = quality.validate_layer(spark, raw, validated, {"one": "csv", "two": "csv"}).collect()
    assert [(r.source, r.status, r.valid, r.failed) for r in found] == [("one", "checked", 1, 1), ("two", "checked", 1, 0)]
    promote = quality.promote
    monkeypatch.setattr(quality, "promote", lambda s, r, root, *more: 1 / 0 if "one" in root else promote(s, r, root, *more))
    found = quality.validate_layer(spark, raw, f"{tmp_path}/again", {"one": "csv", "two": "csv"}).collect()
    assert [(r.source, r.status, r.reason) for r in found] == [("one", "error", "division by zero"), ("two", "checked", None)]


def test_unchanged_files_are_not_read_again(spark, tmp_path, rows):
    put(tmp_path / "raw/dump/players/a.csv", "a,b\n1,one\n")
    put(tmp_path / "raw/dump/games/g.csv", "g\n1\n2\n")
    raw, validated = f"{tmp_path}/raw", f"{tmp_path}/validated"
    assert quality.validate_layer(spark, raw, validated, {"dump": "csv"}).first().valid == 2
    manifest = spark.read.schema(quality.MANIFEST).parquet(f"{validated}/_manifest/dump")
    assert rows(manifest, F.regexp_extract("file_path", "[^/]+$", 0), "rows") == [("a.csv", 1), ("g.csv", 2)]
    # Same size and time: only a reader could tell that the header is another one.
    games = tmp_path / "raw/dump/games/g.csv"
    stamp = games.stat()
    games.write_text("x\n7\n8\n")
    os.utime(games, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    put(tmp_path / "raw/dump/players/b.csv", "b,a\ntwo,2\n")
    put(tmp_path / "raw/dump/players/c.csv", "q\n1\n")
    old = stamp.st_mtime_ns - 10**12
    os.utime(tmp_path / "raw/dump/players/c.csv", ns=(old, old))
    report = quality.check_csv_files(spark, f"{raw}/dump", manifest)
    assert {Path(r.file_path).name: (r.header, r.valid) for r in report.collect()} == {
        "a.csv": ("a,b", True), "b.csv": ("b,a", True), "c.csv": ("q", False), "g.csv": ("g", True)
    }
    found = quality.validate_layer(spark, raw, validated, {"dump": "csv"}).first()
    assert (found.valid, found.failed) == (3, 1)
    assert rows(readers.read_csv(spark, f"{validated}/dump/players"), "a", "b") == [("1", "one"), ("2", "two")]
    # The folder without a changed file was not written again.
    assert rows(readers.read_csv(spark, f"{validated}/dump/games")) == [("1",), ("2",)]
    (tmp_path / "raw/dump/players/a.csv").unlink()
    quality.validate_layer(spark, raw, validated, {"dump": "csv"})
    assert rows(readers.read_csv(spark, f"{validated}/dump/players"), "a") == [("2",)]


def test_raw_naming(spark, tmp_path):
    df = spark.range(2)
    for _ in range(2):
        sinks.write_raw(df, str(tmp_path), "fixed", "json")
        path = sinks.write_raw(df, str(tmp_path), "kept", "json", keep_history=True)
    assert spark.read.json(f"{tmp_path}/fixed").count() == 2
    kept = spark.read.json(path)
    assert kept.count() == 4 and kept.select("ingestion_ts").distinct().count() == 2


@pytest.fixture
def csv_layer(tmp_path):
    put(tmp_path / "raw/dump/players/ok.csv", "id,name\n1,a\n2\n")
    put(tmp_path / "raw/dump/players/header only.csv", "id,name\n")
    put(tmp_path / "raw/dump/players/zero.csv", "")
    put(tmp_path / "raw/dump/players/wide.csv", "id,name\n1,a\n2,b,surplus\n")
    put(tmp_path / "raw/dump/games/quoted.csv", 'id,name\n1,"a, b"\n')
    put(tmp_path / "raw/dump/empty/zero.csv", "")
    put(tmp_path / "raw/dump/games/notes.md", "not data")
    return tmp_path


def test_csv_files(spark, csv_layer):
    report = quality.check_csv_files(spark, f"{csv_layer}/raw/dump")
    got = {Path(r.file_path).name: (r.rows, r.valid, r.reason) for r in report.collect() if "empty" not in r.file_path}
    assert got == {
        "ok.csv": (2, True, None), "header only.csv": (0, False, "empty"), "zero.csv": (0, False, "empty"),
        "wide.csv": (2, False, "broken"), "quoted.csv": (1, True, None),
    }


def test_json_files(spark, tmp_path):
    contents = {
        "ok": '{"a": 1}', "list": "[0]", "empty_object": "{}", "empty_list": " [ ] ", "null": "null", "zero": "0",
        "false": "false", "empty_text": '""', "broken": '{"a": ', "zero_bytes": "",
    }
    for name, text in contents.items():
        put(tmp_path / "j" / f"{name}.json", text)
    report = quality.check_json_files(spark, str(tmp_path / "j"))
    got = {Path(r.file_path).stem: r.valid for r in report.collect()}
    assert got == {name: name in ("ok", "list") for name in contents}
    assert {r.reason for r in report.filter("file_path like '%broken%'").collect()} == {"broken"}


def test_json_lines_files(spark, tmp_path):
    put(tmp_path / "ok.json", '{"a": 1}\n\n{}\n')
    put(tmp_path / "broken.json", '{"a": 1}\n{"a": \n')
    put(tmp_path / "empty.json", "{}\n[]\n")
    report = quality.check_json_files(spark, str(tmp_path), lines=True)
    assert {Path(r.file_path).stem: (r.rows, r.valid) for r in report.collect()} == {
        "ok": (1, True), "broken": (1, False), "empty": (0, False)
    }


def test_validate_and_promote(spark, csv_layer):
    put(csv_layer / "raw/api/matches/m.json", json.dumps({"matches": MATCHES}, indent=2))
    put(csv_layer / "raw/api/matches/bad.json", "{")
    root = str(csv_layer)
    report = quality.validate_layer(
        spark, f"{root}/raw", f"{root}/validated", {"dump": "csv", "api": "json", "absent": "csv"}
    )
    assert {r.source: (r.status, r.reason, r.valid, r.failed) for r in report.collect()} == {
        "dump": ("checked", None, 2, 4), "api": ("checked", None, 1, 1), "absent": ("skipped", "dir_not_found", None, None)
    }
    assert readers.read_csv(spark, f"{root}/validated/dump/players").count() == 2
    promoted = readers.read_wrapped_json(spark, f"{root}/validated/api/matches", "matches", MATCH_ITEM, multiline=False)
    assert promoted.count() == 2
    files = quality.check_csv_files(spark, f"{root}/raw/dump")
    assert [tuple(r) for r in quality.source_report(files, F.lit("dump")).collect()] == [("dump", 2, 4)]


def test_table_rules(spark, rows):
    df = spark.createDataFrame([("1", "a"), ("1", None), ("x", "b"), (None, "c")], "k string, v string")
    assert rows(quality.key_report(df, ["k"], ["v"])) == [(4, 1, 1, 1)]
    assert rows(quality.key_report(df.limit(0), ["k"])) == [(0, 0, 0)]
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
    assert rows(quality.cast_rejects(df, schema, ["v"])) == [("b", "k", "int", "x")]
    assert rows(quality.domain_check(df, "v", ["a", "b"], "CRITICAL")) == [("c", 1, "CRITICAL")]
    with pytest.raises(ValueError):
        quality.domain_check(df, "v", ["a"], "LOUD")


def test_audit(spark, tmp_path):
    path = str(tmp_path / "audit")
    good = audit.audited("s", "e", lambda: spark.range(3), lambda df: df.write.parquet(str(tmp_path / "out")))
    bad = audit.audited("s", "f", lambda: spark.range(3), lambda df: 1 / 0)
    assert (good["endpoint"], good["status"], good["rows_fetched"], good["rows_written"]) == ("e", "success", 3, 3)
    assert good["content_hash"] and good["schema_hash"] and good["metadata"] == {"columns": "id"}
    assert (bad["status"], bad["rows_written"]) == ("error", 0) and "division" in bad["error_message"]
    audit.append_audit(spark, path, [good])
    audit.append_audit(spark, path, [bad])
    log = audit.read_audit(spark, path)
    assert log.count() == 2
    assert [tuple(r) for r in audit.run_summary(log).collect()] == [("s", 1, 2, 3)]
    assert audit.read_audit(spark, str(tmp_path / "none")).count() == 0


def test_schema_drift(spark, tmp_path):
    entries = [audit.entry("s", "e", "success", schema_hash=h) for h in ("a", "a", "b", "a")]
    entries += [audit.entry("s", "f", "success", schema_hash="z"), audit.entry("s", "e", "error", schema_hash="")]
    audit.append_audit(spark, str(tmp_path / "a"), entries)
    drift = audit.schema_drift(audit.read_audit(spark, str(tmp_path / "a"))).orderBy("execution_timestamp")
    assert [(r.previous_hash, r.schema_hash) for r in drift.collect()] == [("a", "b"), ("b", "a")]


def land(root: Path, without=()):
    dumps = {
        "competitions": "competition_id,country_name\nGB1,England\nZZ,Nowhere\n",
        "clubs": "club_id,name,domestic_competition_id\n1,A,GB1\n2,B,ZZ\n,C,GB1\n",
        "players": "player_id,name,current_club_id,extra\n10,a,1.0,kept\n11,b,2,\n12,c,,\n",
        "transfers": "player_id,from_club_id,to_club_id\n10,1,2\n11,2,1\n11,2,2\n",
        "player_valuations": "player_id,date,market_value_in_eur\n10,2024-01-01,5\n11,2024-01-01,6\n",
        "appearances": "appearance_id,player_id,goals,assists,yellow_cards,red_cards,minutes_played\n"
                       "x,10,1,0,0,0,90\ny,11,1,0,0,0,90\n",
        "games": "game_id,date,home_club_id,away_club_id,home_club_name,away_club_name,home_club_goals,away_club_goals,"
                 "competition_type,competition_id\n5,2024-01-01,2,1,B,A,0,1,domestic_league,GB1\n"
                 "6,2024-01-01,2,2,B,B,0,1,domestic_league,GB1\n",
        "game_lineups": "game_id,club_id,player_id,type,team_captain\n5,1,10,starting_lineup,1\n5,2,11,substitutes,0\n",
    }
    for name, text in dumps.items():
        if name in without:
            continue
        (root / "csv").mkdir(parents=True, exist_ok=True)
        with gzip.open(root / "csv" / f"{name}.csv.gz", "wt") as out:
            out.write(text)
    put(root / "json/matches/GB1.json", json.dumps({"matches": MATCHES}, indent=2))
    put(root / "json/matches/ES1.json", json.dumps({"matches": []}))
    put(root / "json/standings/GB1.json", json.dumps(
        {"standings": [{"type": "TOTAL", "table": [{"position": 1, "team": {"name": "A FC"}}]}]}))
    put(root / "json/competition/GB1.json", json.dumps({"id": 1}, indent=2))
    put(root / "json/teams/GB1.json", json.dumps({"teams": [{"id": 1, "note": "line\nbreak"}]}))


def test_cascade(spark, tmp_path):
    land(tmp_path)
    root = str(tmp_path)
    entries = ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit")
    assert {e["endpoint"]: e["rows_written"] for e in entries} == {
        "competitions": 1, "clubs": 2, "players": 1, "transfers": 2, "player_valuations": 1, "appearances": 1,
        "games": 1, "game_lineups": 1,
    }
    assert {e["status"] for e in entries} == {"success"}
    players = readers.read_csv(spark, f"{root}/raw/csv_dump/players").collect()
    assert [(r.player_id, r.current_club_id, r.extra) for r in players] == [("10", "1.0", "kept")]
    log = audit.read_audit(spark, f"{root}/audit")
    assert log.filter("endpoint = 'players'").first().metadata["rows_before_filter"] == "3"


def test_cascade_with_history_uses_the_keys_of_its_run(spark, tmp_path):
    land(tmp_path)
    root = str(tmp_path)
    ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit", keep_history=True)
    with gzip.open(tmp_path / "csv/clubs.csv.gz", "wt") as out:
        out.write("club_id,name,domestic_competition_id\n2,B,GB1\n")
    entries = ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit", keep_history=True)
    assert {e["endpoint"]: e["rows_written"] for e in entries}["players"] == 1
    for _ in range(2):
        ingest.ingest_json(spark, f"{root}/json", f"{root}/raw", f"{root}/audit", keep_history=True)
    items = spark.read.text(f"{root}/raw/json_api/matches")
    assert items.count() == 4 and items.select("ingestion_ts").distinct().count() == 2


def test_cascade_without_a_parent_keeps_its_dependants(spark, tmp_path):
    land(tmp_path, without=("clubs",))
    root = str(tmp_path)
    entries = ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit")
    got = {e["endpoint"]: (e["status"], e["rows_written"]) for e in entries}
    assert got["clubs"] == ("error", 0)
    assert got["players"] == ("success", 3) and got["games"] == ("success", 2)


def test_missing_landing_folder_gives_one_entry(spark, tmp_path):
    root = str(tmp_path)
    for run in (ingest.ingest_dumps, ingest.ingest_json):
        entries = run(spark, f"{root}/none", f"{root}/raw", f"{root}/audit")
        assert [(e["endpoint"], e["status"]) for e in entries] == [("*", "error")]
    assert audit.read_audit(spark, f"{root}/audit").count() == 2


def test_json_ingest(spark, tmp_path):
    land(tmp_path)
    root = str(tmp_path)
    entries = ingest.ingest_json(spark, f"{root}/json", f"{root}/raw", f"{root}/audit")
    assert {e["endpoint"]: (e["status"], e["rows_written"]) for e in entries} == {
        "competition": ("success", 1), "matches": ("success", 2), "standings": ("success", 1), "teams": ("success", 1),
        "scorers": ("error", 0),
    }
    raw = readers.read_wrapped_json(spark, f"{root}/raw/json_api/matches", "matches", MATCH_ITEM, multiline=False)
    assert sorted(r.match_id for r in match_rows(raw).collect()) == [1, 2]


def test_all_layers(spark, tmp_path):
    land(tmp_path)
    root = str(tmp_path)
    ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/raw", f"{root}/audit")
    ingest.ingest_json(spark, f"{root}/json", f"{root}/raw", f"{root}/audit")
    quality.validate_layer(spark, f"{root}/raw", f"{root}/validated", {"csv_dump": "csv", "json_api": "json_lines"})
    report = transform_layer(spark, f"{root}/validated", f"{root}/gold")
    assert {r.table_name: (r.status, r.rows) for r in report.collect()} == {
        "matches": ("written", 2), "standings": ("written", 1), "players": ("written", 1), "clubs": ("written", 2),
        "valuations": ("written", 1), "transfers": ("written", 2), "games": ("written", 1),
    }
    loaded = star.load_star(spark, f"{root}/gold", f"{root}/star").collect()
    assert {r.table_name: (r.status, r.rows_written, r.rows_without_required) for r in loaded} == {
        "dim_clubs": ("loaded", 2, 1), "dim_players": ("loaded", 1, 0), "fact_matches": ("loaded", 2, 0),
        "fact_valuations": ("loaded", 1, 0), "fact_transfers": ("loaded", 2, 0), "fact_games": ("loaded", 1, 0),
    }
    tables = star.open_star(spark, f"{root}/star", register=True)
    assert tables["dim_clubs"].filter("name = 'A'").first().league_position == 1
    assert spark.table("fact_games").first().home_result == "loss"


def test_a_failing_job_does_not_stop_the_others(spark, tmp_path):
    land(tmp_path, without=("transfers",))
    root = str(tmp_path)
    ingest.ingest_dumps(spark, f"{root}/csv", f"{root}/validated", f"{root}/audit")
    report = transform_layer(spark, f"{root}/validated", f"{root}/gold", only=("transfers", "games"))
    assert {r.table_name: r.status for r in report.collect()} == {"transfers": "error", "games": "written"}


def test_star_load_removes_duplicates_and_skips_missing_tables(spark, tmp_path, rows):
    gold_root, star_root = str(tmp_path / "gold"), str(tmp_path / "star")
    values = [("1", "2024-01-01", 5.0), ("1", "2024-01-01", 4.0), ("1", "2024-02-01", 6.0), ("2", "bad", None)]
    df = spark.createDataFrame(values, "player_id string, valuation_date string, market_value_in_eur double")
    df.write.parquet(f"{gold_root}/valuations")
    spark.range(2).write.parquet(f"{gold_root}/clubs")
    report = {r.table_name: r for r in star.load_star(spark, gold_root, star_root).collect()}
    loaded = report["fact_valuations"]
    assert (loaded.rows_read, loaded.rows_written, loaded.duplicates_removed, loaded.rows_without_required) == (4, 3, 1, 1)
    assert report["fact_games"].status == "skipped"
    kept = star.open_star(spark, star_root)["fact_valuations"]
    assert rows(kept.filter("valuation_date = '2024-01-01'"), "market_value_in_eur") == [(4.0,)]


def valuations(spark, players, days, value):
    rows = spark.range(players * days).selectExpr(
        f"lpad(string(id % {players}), 6, '0') as player_id", f"date_add('2020-01-01', int(id div {players})) as valuation_date",
        f"double({value}) as market_value_in_eur")
    return rows.repartition(7)


def test_readers_of_a_star_see_one_whole_version(spark, tmp_path):
    gold_root, star_root = str(tmp_path / "gold"), str(tmp_path / "star")
    assert star.open_star(spark, star_root) == {}
    for name in ("valuations", "players"):
        valuations(spark, 5, 4, 1).write.parquet(f"{gold_root}/{name}")
    star.load_star(spark, gold_root, star_root)
    before = star.open_star(spark, star_root)
    valuations(spark, 9, 4, 2).write.mode("overwrite").parquet(f"{gold_root}/valuations")
    # The refresh of the players fails: no such column type can be read.
    (tmp_path / "gold" / "players" / "part-x.parquet").write_bytes(b"no parquet")
    report = {r.table_name: r.status for r in star.load_star(spark, gold_root, star_root).collect()}
    assert (report["fact_valuations"], report["dim_players"], report["fact_games"]) == ("loaded", "error", "skipped")
    after = star.open_star(spark, star_root)
    totals = [t["fact_valuations"].agg(F.count("*"), F.sum("market_value_in_eur")).first() for t in (before, after)]
    assert [tuple(t) for t in totals] == [(20, 20.0), (36, 72.0)]
    assert before["dim_players"].count() == after["dim_players"].count() == 5
    assert versions.versions(spark, star_root) == [2, 1]
    assert star.open_star(spark, star_root, version=1)["fact_valuations"].count() == 20


def test_a_manifest_that_is_not_whole_is_not_current(spark, tmp_path):
    root = str(tmp_path)
    assert versions.publish(spark, root, {}) is None and versions.published(spark, root) == {}
    assert versions.publish(spark, root, {"a": f"{root}/v-1/a", "b": f"{root}/v-1/b"}) == 1
    (tmp_path / "_versions" / "0000000002.json").write_text('{"a": "v-2')
    assert versions.published(spark, root) == {"a": f"{root}/v-1/a", "b": f"{root}/v-1/b"}
    assert versions.publish(spark, root, {"b": f"{root}/v-3/b"}) == 3
    assert versions.published(spark, root) == {"a": f"{root}/v-1/a", "b": f"{root}/v-3/b"}
    for path in ("v-1/a", "v-1/b", "v-3/b", "v-4/b"):
        (tmp_path / path).mkdir(parents=True)
    assert versions.drop_old(spark, root, keep=1) == ["v-1/b"]
    assert (tmp_path / "v-1" / "a").exists() and (tmp_path / "v-4" / "b").exists()
    assert versions.versions(spark, root) == [3]


def test_star_files_hold_ranges_of_their_keys(spark, tmp_path):
    gold_root, star_root = str(tmp_path / "gold"), str(tmp_path / "star")
    # A third of the rows is of one player.
    many = valuations(spark, 40, 50, 1).unionAll(valuations(spark, 1, 1000, 1).withColumn("player_id", F.lit("000020")))
    many.write.parquet(f"{gold_root}/valuations")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = {r.table_name: r for r in star.load_star(spark, gold_root, star_root).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    line = report["fact_valuations"]
    distinct = many.select("player_id", "valuation_date").distinct().count()
    assert (line.rows_read, line.rows_written, line.duplicates_removed) == (3000, distinct, 3000 - distinct)
    key = F.struct("player_id", "valuation_date")
    found = star.open_star(spark, star_root)["fact_valuations"].groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).orderBy("low").collect()
    assert len(found) >= 4 and all(a.high < b.low for a, b in zip(found, found[1:]))
    assert max(f.n for f in found) < distinct / 2


def test_work_dir_is_below_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    if named:
        assert first.startswith(named)


def test_text_layers_are_compressed_and_checked(spark, rows, tmp_path):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit("a, b").alias("note")).coalesce(1)
    sinks.write_raw(df, f"{tmp_path}/raw/dump", "players", "csv")
    sinks.write_raw(df.select(F.to_json(F.struct("id")).alias("value")), f"{tmp_path}/raw/api", "teams", "text")
    found = quality.validate_layer(spark, f"{tmp_path}/raw", f"{tmp_path}/validated", {"dump": "csv", "api": "json_lines"}).collect()
    assert [(r.status, r.valid, r.failed) for r in found] == [("checked", 1, 0), ("checked", 1, 0)]
    for layer in ("raw", "validated"):
        files = [p.name for p in (tmp_path / layer).rglob("part-*") if "_manifest" not in str(p)]
        assert len(files) == 2 and all(name.endswith(".gz") for name in files)
        assert rows(readers.read_csv(spark, f"{tmp_path}/{layer}/dump/players")) == rows(df)
        assert spark.read.text(f"{tmp_path}/{layer}/api/teams").count() == 500


def test_layers_of_text_take_fast_gzip(spark, tmp_path):
    """The file holds what zlib makes at its fastest level, not at its default one."""
    sinks.write_text(spark.range(20_000).selectExpr("concat(id, ',', id * 37 % 1001)").coalesce(1), f"{tmp_path}/t")
    (file,) = (tmp_path / "t").glob("*.gz")
    text = gzip.decompress(file.read_bytes())
    assert text.count(b"\n") == 20_000
    fast, default = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(file.stat().st_size - fast) < abs(file.stat().st_size - default)


def test_valuations_are_shuffled_once_for_keys_and_files(spark, rows):
    """One row per key, null keys and keys on both sides of a batch included, with one shuffle instead of two."""
    kinds = "player_id string, valuation_date string, market_value_in_eur double, player_name string"
    data = [(p, d, v, n) for p in (*"abc", None) for d in ("2020-01-01", None) for v in (3.0, 1.0, None, 2.0) for n in ("y", "x", None)]
    gold = spark.createDataFrame(data * 3, kinds).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        kept = star.star_rows(gold, "valuations", "fact_valuations")
        found = rows(kept, "player_id", F.col("valuation_date").cast("string"), "market_value_in_eur", "player_name")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == rows(spark.createDataFrame([(p, d, None, None) for p in (*"abc", None) for d in ("2020-01-01", None)], kinds))
    plan = star.star_rows(gold.coalesce(1), "valuations", "fact_valuations")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    # A task sends one row of a key.
    once = windows.first_in_ranges(spark.range(1_000).selectExpr("id % 2 AS k", "id AS v").coalesce(1), ["k"], [F.col("v")])
    assert rows(once) == [(0, 0), (1, 1)]
    shown = once._jdf.queryExecution().optimizedPlan().toString()
    assert shown.index("RepartitionByExpression") < shown.index("MapInArrow")


def test_lines_of_many_files_in_one_task_are_counted_by_file(spark, tmp_path):
    """Headers with quotes, blank lines before the header, and rows of other widths; no path or line is sorted for it."""
    texts = {
        "a": 'x,"y,z",w\n1,"a,b",2\n"q""r,",3,4\n', "b": "\n \nx,y\n1,2\n1,2,3\n\n", "c": "x,y\n", "d": "x,y\n" + "1,2\n" * 25_000, "e": 'x,y\n"open,1\n',
    }
    os.makedirs(f"{tmp_path}/some where/t=1")
    for name, text in texts.items():
        with gzip.open(f"{tmp_path}/some where/t=1/{name}.csv.gz", "wt") as f:
            f.write(text)
    with open(f"{tmp_path}/some where/t=1/f.csv", "w") as f:
        f.write("x,y\n" + "1,2\n" * 60_000)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        manifest = quality.file_manifest(spark, f"{tmp_path}/some where", "csv")
        found = {os.path.basename(r.file_path)[0]: (r.header, r.rows, r.broken) for r in manifest.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == {
        "a": ('x,"y,z",w', 2, 0), "b": ("x,y", 2, 1), "c": ("x,y", 0, 0), "d": ("x,y", 25_000, 0), "e": ("x,y", 1, 0), "f": ("x,y", 60_000, 0),
    }
    counted = quality._csv_counts(spark.read.option("recursiveFileLookup", True).text(f"{tmp_path}/some where"))
    assert "Sort" not in counted._jdf.queryExecution().executedPlan().toString()


def test_json_documents_are_parsed_once_and_not_sorted(spark, tmp_path):
    documents = ['{"a": 1}', "{}", " { } ", "[]", "[[]]", "null", "0", "0.0", "-0", '""', "false", "true", '{"a": ', '{"": null}', "[1", '"x"', "{'a': 1}"]
    spark.createDataFrame([(d,) for d in documents], "value string").coalesce(1).write.text(str(tmp_path / "j"))
    texts = spark.read.text(str(tmp_path / "j"))
    row = quality._json_counts(texts, True).first()
    assert (row.rows, row.broken) == (5, 3)
    assert "Sort" not in quality._json_counts(texts, True)._jdf.queryExecution().executedPlan().toString()


def test_rows_are_sorted_before_the_shuffle_only_for_crowded_keys(spark, rows):
    spread = spark.range(1_000).selectExpr("id DIV 2 AS k", "id AS v")
    crowded = spark.range(1_000).selectExpr("CASE WHEN id % 2 = 0 THEN NULL ELSE id DIV 4 END AS k", "id AS v")
    for df, sorted_first in ((spread, False), (crowded, True), (spread.limit(0), False)):
        once = windows.first_in_ranges(df, ["k"], [F.col("v")])
        assert rows(once) == rows(df.groupBy("k").agg(F.min("v").alias("v")))
        assert ("MapInArrow" in once._jdf.queryExecution().optimizedPlan().toString()) == sorted_first
