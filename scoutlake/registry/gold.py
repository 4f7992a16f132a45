"""The gold jobs, the scout view and the pieces they are made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from scoutlake.operators.aggregates import distinct_per_key, lineup_by_club, sum_profile
from scoutlake.operators.ranges import stored_parts
from scoutlake.plans import gold
from scoutlake.plans.scout_view import scout_view
from scoutlake.registry import Query
from scoutlake.registry.oracle import oracle
from scoutlake.registry.shapes import match_items, shape, standing_items

AS_OF = dt.date(2025, 6, 1)


def players(spark: SparkSession, sf: str) -> DataFrame:
    raw = (shape(spark, sf, name) for name in ("players", "appearances", "defense"))
    return gold.players_gold(*raw, as_of=AS_OF)


def clubs(spark: SparkSession, sf: str) -> DataFrame:
    items = standing_items(spark, sf)
    return gold.clubs_gold(shape(spark, sf, "clubs"), shape(spark, sf, "players"), items, as_of=AS_OF)


def valuations(spark: SparkSession, sf: str) -> DataFrame:
    return gold.valuations_gold(shape(spark, sf, "player_valuations"), shape(spark, sf, "players"))


def transfers(spark: SparkSession, sf: str) -> DataFrame:
    return gold.transfers_gold(shape(spark, sf, "transfers"), shape(spark, sf, "players"))


def games(spark: SparkSession, sf: str, stored: Sequence[str] = ()) -> DataFrame:
    """The gold table, or the columns of `stored`, which are written down for several readers."""
    whole = gold.games_gold(shape(spark, sf, "games"), shape(spark, sf, "game_lineups"))
    return stored_parts(whole.select(*stored), "games") if stored else whole


def matches(spark: SparkSession, sf: str) -> DataFrame:
    return gold.matches_gold(match_items(spark, sf), shape(spark, sf, "games"))


def standings(spark: SparkSession, sf: str) -> DataFrame:
    return gold.standings_gold(standing_items(spark, sf))


def scout(spark: SparkSession, sf: str) -> DataFrame:
    return scout_view(players(spark, sf), clubs(spark, sf))


def appearance_totals(spark: SparkSession, sf: str) -> DataFrame:
    raw = shape(spark, sf, "appearances")
    return sum_profile(raw, "player_id", gold.APPEARANCE_SUMS, "appearance_id", "total_appearances")


def lineup_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lineup_by_club(shape(spark, sf, "game_lineups"))


def players_involved(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_per_key(shape(spark, sf, "game_lineups"), "game_id", "player_id", "total_players_involved")


def squad(spark: SparkSession, sf: str) -> DataFrame:
    return gold.squad_summary(shape(spark, sf, "players"), AS_OF)


def match_fields(spark: SparkSession, sf: str) -> DataFrame:
    return gold.match_rows(match_items(spark, sf))


QUERIES = {
    "gold_players": Query(players, oracle("SELECT * FROM g_players")),
    "gold_clubs": Query(clubs, oracle("SELECT * FROM g_clubs")),
    "gold_valuations": Query(valuations, oracle("SELECT * FROM g_valuations")),
    "gold_transfers": Query(transfers, oracle("SELECT * FROM g_transfers")),
    "gold_games": Query(games, oracle("SELECT * FROM g_games")),
    "gold_matches": Query(matches, oracle("SELECT * FROM g_matches")),
    "gold_standings": Query(standings, oracle("SELECT * FROM g_standings")),
    "scout_view": Query(scout, oracle("SELECT * FROM scout")),
    "appearance_totals": Query(
        appearance_totals,
        oracle(
            """SELECT player_id, CAST(sum(goals) AS BIGINT) AS total_goals, CAST(sum(assists) AS BIGINT) AS total_assists,
                 CAST(sum(yellow_cards) AS BIGINT) AS total_yellow, CAST(sum(red_cards) AS BIGINT) AS total_red,
                 CAST(sum(minutes_played) AS BIGINT) AS total_minutes, count(appearance_id) AS total_appearances
               FROM appearances GROUP BY player_id"""
        ),
    ),
    "squad_summary": Query(squad, oracle("SELECT * FROM squad")),
    "lineup_counts": Query(
        lineup_counts,
        oracle(
            """SELECT game_id, club_id, count(*) FILTER (type = 'starting_lineup') AS starters,
                 count(*) FILTER (type = 'substitutes') AS subs, CAST(sum(team_captain) AS BIGINT) AS captain_count
               FROM game_lineups GROUP BY game_id, club_id"""
        ),
    ),
    "players_involved": Query(
        players_involved,
        oracle(
            "SELECT game_id, count(DISTINCT player_id) AS total_players_involved FROM game_lineups GROUP BY game_id"
        ),
    ),
    "match_fields": Query(
        match_fields,
        oracle(
            """SELECT match_id, matchday, utc_date, status, home_id AS home_team_id, 'TEAM ' || home_id AS home_team,
                 'T' || home_id AS home_team_short, CAST(NULL AS VARCHAR) AS home_team_crest,
                 away_id AS away_team_id, 'TEAM ' || away_id AS away_team, 'T' || away_id AS away_team_short,
                 CAST(NULL AS VARCHAR) AS away_team_crest, home_goals AS home_score, away_goals AS away_score,
                 winner, season_start, season_end FROM match_rows"""
        ),
    ),
}
