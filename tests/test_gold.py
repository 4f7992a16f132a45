import datetime as dt

from pyspark.sql import functions as F, types as T

from scoutlake.contracts import DEFENSE_CSV, GOLD, MATCH_ITEM, RAW_CSV, STANDING_ITEM
from scoutlake.operators.relational import conform
from scoutlake.plans import gold, reports
from scoutlake.plans.scout_view import register_scout_view, scout_view

AS_OF = dt.date(2025, 6, 1)


def raw(spark, name, *records):
    """Rows of a raw table from dicts; missing columns are null."""
    schema = RAW_CSV[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in records], schema)


def gold_rows(spark, name, *records):
    schema = GOLD[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in records], schema)


def by(df, key):
    return {r[key]: r for r in df.collect()}


PLAYERS = (
    dict(player_id=1, name="A", date_of_birth="2000-06-02", position="Attack", current_club_id=10, market_value_in_eur=4e6,
         highest_market_value_in_eur=6e6, contract_expiration_date="2026-06-30 00:00:00", country_of_citizenship="X"),
    dict(player_id=2, name="B", date_of_birth=None, current_club_id=10, market_value_in_eur=2e6),
    dict(player_id=3, name="C", date_of_birth="31/12/1999", current_club_id=99),
)


def test_players(spark):
    appearances = raw(
        spark, "appearances",
        dict(appearance_id="1", player_id=1, goals=2, assists=1, yellow_cards=0, red_cards=0, minutes_played=90),
        dict(appearance_id=None, player_id=1, goals=None, assists=1, yellow_cards=1, red_cards=1, minutes_played=10),
    )
    defense = spark.createDataFrame([(1, 2.35, 1.0, None)], DEFENSE_CSV)
    got = gold.players_gold(raw(spark, "players", *PLAYERS), appearances, defense, AS_OF)
    assert got.columns == GOLD["players"].fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in GOLD["players"]]
    rows = by(got, "player_id")
    one = rows["1"]
    assert (one.age, one.total_goals, one.total_assists, one.total_red, one.total_minutes, one.total_appearances) == (
        24, 2, 2, 1, 100, 1
    )
    assert (one.tackles_per_90, one.pass_completion_pct) == (2.35, 0.0)
    assert one.contract_expiration_date == dt.date(2026, 6, 30)
    two, three = rows["2"], rows["3"]
    assert (two.age, three.age, three.date_of_birth) == (None, None, None)
    assert (two.total_goals, two.total_minutes, two.total_appearances, two.tackles_per_90) == (0, 0, 0, 0.0)


def test_players_without_defence_data_or_birth_date(spark):
    players = raw(spark, "players", *PLAYERS).drop("date_of_birth", "agent_name")
    got = gold.players_gold(players, raw(spark, "appearances"), None, AS_OF)
    assert "agent_name" not in got.columns
    assert {(r.age, r.interceptions_per_90) for r in got.collect()} == {(None, 0.0)}


def standings(spark, *groups):
    team = lambda name: (1, name, None, None)
    data = [
        ((kind, [(pos, team(name), 3, 1, 1, 1, 4, 5, 6, -1, "W") for pos, name in table]),) for kind, table in groups
    ]
    return spark.createDataFrame(data, T.StructType([T.StructField("item", STANDING_ITEM)]))


def test_standings_keep_total_groups_only(spark):
    items = standings(spark, ("TOTAL", [(1, "A"), (2, "B")]), ("HOME", [(1, "B")]), ("TOTAL", []))
    got = gold.standings_gold(items)
    assert got.columns == GOLD["standings"].fieldNames()
    assert sorted((r.position, r.team_name, r.goals_against) for r in got.collect()) == [(1, "A", 6), (2, "B", 6)]


def test_clubs(spark):
    clubs = raw(
        spark, "clubs", dict(club_id=10, name="Porto FC"), dict(club_id=11, name="Benfica"), dict(club_id=12, name="Empty")
    )
    # Two source names end at one club: one row, the better match.
    items = standings(spark, ("TOTAL", [(4, "FC Porto"), (1, "Portoo"), (2, "SL Benfica")]), ("HOME", [(9, "Empty")]))
    rows = by(gold.clubs_gold(clubs, raw(spark, "players", *PLAYERS), items, AS_OF), "club_id")
    assert len(rows) == 3
    ten = rows["10"]
    assert (ten.league_position, ten.player_count, ten.total_squad_value, ten.avg_player_value) == (4, 2, 6e6, 3e6)
    assert ten.avg_age == (AS_OF - dt.date(2000, 6, 2)).days / 365.25
    assert (rows["11"].league_position, rows["11"].player_count) == (2, None)
    assert rows["12"].league_position is None


def test_valuations(spark):
    values = [
        (1, "2024-01-01", 100.0, 7), (1, "2024-01-01", 200.0, 7), (1, "2024-03-01", 0.0, 7), (1, "2024-04-01", 50.0, 7),
        (1, "bad", 5.0, 7), (4, "2024-01-01", 9.0, 7),
    ]
    history = raw(
        spark, "player_valuations",
        *(dict(player_id=p, date=d, market_value_in_eur=v, current_club_id=c) for p, d, v, c in values),
    )
    got = gold.valuations_gold(history, raw(spark, "players", *PLAYERS))
    assert got.columns == GOLD["valuations"].fieldNames()
    rows = {(r.player_id, r.market_value_in_eur): r for r in got.collect()}
    assert rows["1", 5.0].valuation_date is None and rows["1", 5.0].prev_value is None
    changes = [(rows["1", v].prev_value, rows["1", v].value_change_pct) for v in (100.0, 200.0, 0.0, 50.0)]
    assert changes == [(5.0, 1900.0), (100.0, 100.0), (200.0, -100.0), (0.0, None)]
    assert (rows["1", 50.0].age_at_valuation, rows["4", 9.0].player_name) == (23, None)


def test_transfers(spark):
    moves = raw(
        spark, "transfers",
        dict(player_id=1, transfer_date="2024-07-01", transfer_fee=None, market_value_in_eur=1.0, to_club_id=1),
        dict(player_id=1, transfer_date="nope", transfer_fee=0.0, market_value_in_eur=1.5, to_club_id=2),
        dict(player_id=8, transfer_date="2024-07-01", transfer_fee=5.0, market_value_in_eur=None, to_club_id=3),
    )
    rows = by(gold.transfers_gold(moves, raw(spark, "players", *PLAYERS)), "to_club_id")
    assert [(rows[k].transfer_type, rows[k].fee_vs_market_diff, rows[k].age_at_transfer) for k in "123"] == [
        ("unknown", None, 24), ("free/loan", -1.5, None), ("paid", None, None)
    ]


def test_games(spark):
    games = raw(
        spark, "games",
        dict(game_id=1, date="2024-01-01", home_club_goals=2, away_club_goals=1),
        dict(game_id=2, date="2024-01-01", home_club_goals=None, away_club_goals=None),
        dict(game_id=3, date="2024-01-01", home_club_goals=0, away_club_goals=1),
    )
    lineups = raw(
        spark, "game_lineups", dict(game_id=1, club_id=1, player_id=5), dict(game_id=1, club_id=2, player_id=5),
        dict(game_id=1, club_id=2, player_id=6),
    )
    rows = by(gold.games_gold(games, lineups), "game_id")
    assert [(rows[k].total_goals, rows[k].home_result, rows[k].total_players_involved) for k in "123"] == [
        (3, "win", 2), (0, "draw", None), (1, "loss", None)
    ]


def match(id, day, home, status="FINISHED"):
    team = lambda name: None if name is None else (1, name, name, None)
    return ((id, 1, f"{day}T22:00:00Z", status, team(home), team("X"), ("DRAW", (2, 2)), (day, None)),)


def test_matches(spark):
    items = spark.createDataFrame(
        [match(1, "2026-01-28", "CA Mineiro"), match(1, "2026-01-28", "CA Mineiro"), match(2, "2026-01-29", "CA Mineiro"),
         match(3, "2026-01-28", None), match(4, "2026-01-28", "Qwghlm")],
        T.StructType([T.StructField("item", MATCH_ITEM)]),
    )
    games = raw(
        spark, "games",
        dict(game_id=7, date="2026-01-28", home_club_name="Clube Mineiro", stadium="Arena", attendance=25770),
        dict(game_id=5, date="2026-01-28", home_club_name="Clube Mineiro", stadium="Other"),
        dict(game_id=6, date="2026-01-28", home_club_name="Palmeiras", stadium="Allianz"),
    )
    got = gold.matches_gold(items, games)
    assert got.columns == GOLD["matches"].fieldNames()
    rows = by(got, "match_id")
    assert sorted(rows) == ["1", "2", "3", "4"]
    assert (rows["1"].utc_date, rows["1"].tm_game_id, rows["1"].stadium) == (dt.date(2026, 1, 28), 5.0, "Other")
    assert (rows["1"].home_score, rows["1"].season_start) == (2.0, dt.date(2026, 1, 28))
    assert [rows[k].tm_game_id for k in "234"] == [None, None, None]


def player(**values):
    base = dict(
        player_id="1", name="A", age=22, position="Attack", current_club_id="10", current_club_name="Porto",
        country_of_citizenship="X", market_value_in_eur=4e6, highest_market_value_in_eur=6e6, total_goals=10,
        total_assists=4, total_yellow=0, total_red=1, total_minutes=2100, total_appearances=30,
        contract_expiration_date=dt.date(2026, 6, 30), tackles_per_90=2.0, interceptions_per_90=1.0,
        pass_completion_pct=80.0,
    )
    return base | values


def test_scout_view(spark):
    players = gold_rows(
        spark, "players", player(), player(player_id="2", market_value_in_eur=0.0), player(player_id="3", age=None),
        player(player_id="4", total_goals=0, total_assists=0, total_minutes=0, current_club_id="77"),
        player(player_id="5", market_value_in_eur=None),
    )
    clubs = gold_rows(spark, "clubs", dict(club_id="10", name="Porto FC", squad_size=25))
    rows = by(scout_view(players, clubs), "player_id")
    assert sorted(rows) == ["1", "3", "4"]
    one, four = rows["1"], rows["4"]
    assert (one.club_name, one.goal_contributions, one.impact_score, one.defensive_reliability) == ("Porto FC", 14, 26.0, 7.1)
    assert (one.cost_per_impact, one.cost_per_contribution, one.contributions_per_90, one.upside_value) == (
        153846.0, 285714.0, 0.6, 2e6
    )
    assert rows["3"].upside_value == 0.0
    assert (four.club_name, four.cost_per_impact, four.cost_per_contribution, four.contributions_per_90) == (None,) * 4
    register_scout_view(players, clubs)
    assert spark.table("master_scout").count() == 3


def test_player_reports(spark):
    players = gold_rows(
        spark, "players", player(), player(player_id="2", age=26), player(player_id="3", market_value_in_eur=5.1e6),
        player(player_id="4", total_minutes=1999), player(player_id="5", total_goals=20), player(player_id="6", total_goals=1),
        player(player_id="7", contract_expiration_date=dt.date(2027, 1, 1)),
    )
    gems = reports.undervalued_gems(players).collect()
    assert [r.player_id for r in gems] == ["5", "1", "7"]
    assert (gems[1].value_m, gems[1].contributions_per_90, gems[1].cost_per_contribution) == (4.0, 0.6, 285714.0)
    ends = reports.expiring_contracts(players)
    assert [r.player_id for r in ends.collect()] == ["3", "1", "2", "4", "5", "6"]
    brief = reports.expiring_contracts_brief(players, n=1).first()
    assert (brief.value_m, brief.contract_until) == (5.1, "2026-06-30")
    shown = reports.published(reports.undervalued_gems(players), "undervalued_gems")
    assert list(reports.HEADINGS["undervalued_gems"].values()) == shown.columns
    view = scout_view(players, gold_rows(spark, "clubs"))
    cheap = [r.player_id for r in reports.undervalued_by_impact(view).collect()]
    assert cheap == ["5", "1", "7", "6"]


def test_value_reports(spark):
    def value(player_id, day, value, change=None, name="A"):
        return dict(player_id=player_id, player_name=name, valuation_date=dt.date.fromisoformat(day),
                    market_value_in_eur=value, value_change_pct=change)

    values = gold_rows(
        spark, "valuations", value("1", "2020-01-01", 1e6), value("1", "2021-01-01", 9e6, 800.0),
        value("1", "2022-01-01", 3e6, None), value("2", "2020-01-01", 6e6), value("2", "2021-01-01", 9e6, 50.0),
        value("3", "2020-01-01", 2e6), value("3", "2021-01-01", 1e6, -50.0), value("4", "2021-01-01", 4e5, 90.0),
    )
    grown = reports.biggest_appreciation(values).collect()
    assert [(r.player_id, r.first_value_m, r.last_value_m, r.gain_m, r.gain_pct) for r in grown] == [("1", 1.0, 3.0, 2.0, 200.0)]
    # The newest known change counts, not the newest row.
    assert [(r.player_id, r.change_pct) for r in reports.rising_now(values).collect()] == [("1", 800.0), ("2", 50.0)]
    assert reports.rising_now_brief(values, 1).first().valuation_date == "2021-01-01"


def test_transfer_and_game_reports(spark):
    def move(player_id, fee, market, club="S", kind="paid"):
        diff = None if fee is None or market is None else fee - market
        return dict(player_id=player_id, from_club_name=club, transfer_fee=fee, market_value_in_eur=market,
                    fee_vs_market_diff=diff, transfer_type=kind)

    moves = gold_rows(
        spark, "transfers", move("1", 9e6, 1e6), move("2", 5e6, 4e6), move("3", 2e6, 3e6), move("4", None, 1e6, kind="unknown"),
        move("5", 1e6, None, "T"), move("6", 1e6, 1e6, "T"),
    )
    assert [(r.player_id, r.diff_m) for r in reports.best_transfer_returns(moves).collect()] == [("1", 8.0), ("2", 1.0)]
    assert reports.transfer_returns_brief(moves, 1).columns == [
        "player_id", "name", "position", "age", "from_club", "to_club", "fee_m", "market_value_m", "diff_m"
    ]
    sellers = reports.top_selling_clubs(moves).collect()
    assert [(r.club, r.sales, r.revenue_m, r.total_diff_m) for r in sellers] == [("S", 3, 16.0, 8.0)]

    def game(id, result, goals, league="L", kind="domestic_league"):
        return dict(game_id=id, competition_id=league, competition_type=kind, total_goals=goals, home_result=result,
                    attendance=100)

    games = gold_rows(
        spark, "games", game("1", "win", 3), game("2", "win", 2), game("3", "draw", 0), game("4", "win", 9, kind="cup"),
        game("5", "loss", 4, "M"), game("6", "loss", None, "M"),
    )
    stats = reports.league_stats(games).collect()
    assert [(r.league, r.games, r.goals, r.mean_goals, r.home_win_pct) for r in stats] == [
        ("M", 1, 4, 4.0, 0), ("L", 3, 5, 1.67, 66)
    ]
    counts = reports.row_counts({"dim_clubs": games, "fact_matches": moves})
    assert {tuple(r) for r in counts.collect()} == {("dim_clubs", 6), ("fact_matches", 6)}
    assert reports.row_counts({"dim_clubs": games, "fact_matches": moves}, include_matches=False).count() == 1
