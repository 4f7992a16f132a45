"""Model features, models and predictions."""

from __future__ import annotations

import functools

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake.ml import match_goals, model_store, player_value
from scoutlake.registry import Query, gold
from scoutlake.registry.oracle import oracle
from scoutlake.session import shared_root, work_dir


def player_features(spark: SparkSession, sf: str) -> DataFrame:
    """All inputs of the model but the ordinal of the position, which `encoded_positions` shows, and the target."""
    inputs = [c for c in player_value.FEATURES if c != "position_enc"]
    features = player_value.player_features(gold.players(spark, sf), impute_height=True)
    return features.select("player_id", "position", *inputs, player_value.LEAKING_FEATURE, player_value.TARGET)


def encoded_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinal of the position in alphabetical order, unknown ones included."""
    players = gold.players(spark, sf).select("player_id", "position").na.fill("Unknown", ["position"])
    indexer = StringIndexer(inputCol="position", outputCol="position_enc", stringOrderType="alphabetAsc")
    return indexer.fit(players).transform(players)


def team_strength(spark: SparkSession, sf: str) -> DataFrame:
    return match_goals.team_strength(gold.games(spark, sf))


def game_features(spark: SparkSession, sf: str) -> DataFrame:
    games = gold.games(spark, sf)
    return match_goals.game_features(games, match_goals.team_strength(games))


@functools.lru_cache(maxsize=1)
def _own_store(application: str, spark: SparkSession) -> str:
    return work_dir(spark, "models")


def _store(spark: SparkSession) -> str:
    """Models are kept in the shared folder; a session that names none has a folder of its own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return f"{shared_root(spark)}/scoutlake/models"
    return _own_store(spark.sparkContext.applicationId, spark)


def _player_model(spark: SparkSession, sf: str):
    """The model, which stores its rows, with its training and held-out rows; together they are all rows with features."""
    return player_value.train_player_value(player_value.player_features(gold.players(spark, sf)), store=_store(spark))


def player_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    trained, train, held_out = _player_model(spark, sf)
    return trained.metrics(train=train, held_out=held_out)


def player_model_importances(spark: SparkSession, sf: str) -> DataFrame:
    trained, _, _ = _player_model(spark, sf)
    return trained.importances(spark)


def value_potential(spark: SparkSession, sf: str) -> DataFrame:
    trained, train, held_out = _player_model(spark, sf)
    return player_value.value_potential(trained, train.unionByName(held_out))


# What the strengths and features read of a game.
GAME_COLUMNS = (
    "game_id", "competition_type", "home_club_id", "away_club_id", "home_club_name", "home_club_goals", "away_club_goals",
    "total_goals", "attendance",
)


def _goals_model(spark: SparkSession, sf: str):
    """Games, strengths and features are stored, the last by the training, as each is read by several passes."""
    games = gold.games(spark, sf, GAME_COLUMNS)
    strength = match_goals.team_strength(games, match_goals.MIN_GAMES, True)
    features = match_goals.game_features(games, strength)
    return strength, *match_goals.train_match_goals(features, store=_store(spark))


def goals_model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, trained, train, held_out = _goals_model(spark, sf)
    return trained.metrics(train=train, held_out=held_out)


def fixture_predictions(spark: SparkSession, sf: str) -> DataFrame:
    strength, trained, _, _ = _goals_model(spark, sf)
    return match_goals.predict_fixtures(trained, strength, FIXTURES)


FIXTURES = [("Team 1 ", "team 2 "), ("TEAM 17", "Team 23 FC"), ("Nowhere", "Team 1 "), ("Team 5 ", "Nowhere")]


def fixture_clubs(spark: SparkSession, sf: str) -> DataFrame:
    """What the predictions hold beside the model's own goals: clubs, status, expected goals and score line."""
    columns = ["fixture", "home", "away", "home_club", "away_club", "status", "expected_home", "expected_away", "likely_score"]
    return fixture_predictions(spark, sf).select(columns)


def player_scores_by_tree_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per player: is the model's score the one that the table of its trees gives?"""
    trained, train, held_out = _player_model(spark, sf)
    features = train.unionByName(held_out)
    nodes = model_store.tree_table(spark, trained, work_dir(spark, "trees"))
    scores = model_store.tree_scores(trained, features, "player_id", nodes)
    own = trained.model.transform(features).select("player_id", "prediction").join(scores, "player_id", "left")
    near = F.abs(F.col("prediction") - F.col("tree_score")) <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))
    return own.select("player_id", F.coalesce(near, F.lit(False)).alias("same"))


def goals_by_tree_table(spark: SparkSession, sf: str) -> DataFrame:
    """Per league game: is the model's score the one that the table of its trees gives?"""
    _, trained, train, held_out = _goals_model(spark, sf)
    features = train.unionByName(held_out)
    nodes = model_store.tree_table(spark, trained, work_dir(spark, "trees"))
    scores = model_store.tree_scores(trained, features, "game_id", nodes)
    own = trained.model.transform(features).select("game_id", "prediction").join(scores, "game_id", "left")
    near = F.abs(F.col("prediction") - F.col("tree_score")) <= 1e-9 * F.greatest(F.abs("prediction"), F.lit(1.0))
    return own.select("game_id", F.coalesce(near, F.lit(False)).alias("same"))


def found_clubs(spark: SparkSession, sf: str) -> DataFrame:
    strength = match_goals.team_strength(gold.games(spark, sf))
    return match_goals.find_clubs(strength, ["team 1", "TEAM 2[0-9]", "9 FC", "nowhere"]).select(
        "pattern", "club.club_name", "club.club_id"
    )


def held_out_games(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the rows that the key hash holds out."""
    games = gold.games(spark, sf)
    train, held_out = match_goals.split_by_key(games, "game_id")
    again = match_goals.split_by_key(games.repartition(5), "game_id")[1].select(F.col("game_id").alias("again"))
    counted = held_out.join(again, F.col("game_id") == F.col("again"), "full").agg(
        F.count("game_id").alias("held_out"), F.count_if(F.col("game_id") == F.col("again")).alias("stable")
    )
    share = F.col("held_out") / (F.col("held_out") + train.agg(F.count("*")).scalar())
    return counted.select(share.between(0.15, 0.25).alias("a_fifth"), (F.col("stable") == F.col("held_out")).alias("same"))


PLAYER_FEATURES = oracle("""SELECT player_id, coalesce(position, 'Unknown') AS position, age, total_goals, total_assists,
                    total_minutes, total_appearances,
                    CAST(total_goals AS DOUBLE) / total_minutes * 90 AS goals_per_90,
                    CAST(total_assists AS DOUBLE) / total_minutes * 90 AS assists_per_90,
                    CAST(total_goals AS DOUBLE) / total_minutes * 90
                      + CAST(total_assists AS DOUBLE) / total_minutes * 90 AS ga_per_90,
                    CAST(total_minutes AS DOUBLE)
                      / CASE WHEN total_appearances = 0 THEN 1 ELSE total_appearances END AS minutes_per_appearance,
                    CAST(total_yellow + total_red AS DOUBLE) / total_minutes * 90 AS cards_per_90,
                    coalesce(height_in_cm, median(height_in_cm) OVER ()) AS height_in_cm,
                    market_value_in_eur / CASE WHEN highest_market_value_in_eur = 0 THEN 1
                                               ELSE highest_market_value_in_eur END AS value_ratio,
                    highest_market_value_in_eur
                  FROM g_players WHERE market_value_in_eur > 0 AND age IS NOT NULL AND total_minutes > 0""")

_LEAGUE_GAMES = """SELECT g.game_id FROM g_games g JOIN strength h ON h.club_id = g.home_club_id
                  JOIN strength a ON a.club_id = g.away_club_id
                  WHERE g.competition_type = 'domestic_league' AND g.total_goals IS NOT NULL"""


def _first_club(pattern: str) -> str:
    return f"""SELECT s FROM strength s WHERE contains(lower(s.club_name), lower('{pattern}'))
               ORDER BY s.club_name, s.club_id LIMIT 1"""


def _fixture_line(number: int, home: str, away: str) -> str:
    return f"""SELECT {number} AS fixture, '{home}' AS home, '{away}' AS away, h.club_name AS home_club, a.club_name AS away_club,
        CASE WHEN h IS NULL THEN 'club not found: {home}' WHEN a IS NULL THEN 'club not found: {away}' ELSE 'predicted' END AS status,
        h.avg_goals_scored_home * a.avg_goals_conceded_away / (SELECT avg(avg_goals_conceded_away) FROM strength) AS eh,
        a.avg_goals_scored_away * h.avg_goals_conceded_home / (SELECT avg(avg_goals_conceded_home) FROM strength) AS ea
      FROM (SELECT ({_first_club(home)}) AS h, ({_first_club(away)}) AS a)"""


FIXTURE_CLUBS = oracle(f"""SELECT fixture, home, away, home_club, away_club, status, round(eh, 1) AS expected_home,
    round(ea, 1) AS expected_away, CASE WHEN status = 'predicted' THEN CAST(round_even(eh, 0) AS INTEGER) || '-' || CAST(round_even(ea, 0) AS INTEGER)
    END AS likely_score FROM ({' UNION ALL '.join(_fixture_line(i, *f) for i, f in enumerate(FIXTURES))}) lines""")

QUERIES = {
    "fixture_clubs": Query(fixture_clubs, FIXTURE_CLUBS),
    "player_scores_by_tree_table": Query(
        player_scores_by_tree_table,
        oracle("""SELECT player_id, true AS same FROM g_players WHERE market_value_in_eur > 0 AND age IS NOT NULL
                  AND total_minutes > 0 AND height_in_cm IS NOT NULL AND highest_market_value_in_eur IS NOT NULL"""),
    ),
    "goals_by_tree_table": Query(goals_by_tree_table, oracle(f"SELECT game_id, true AS same FROM ({_LEAGUE_GAMES}) played")),
    "player_features": Query(player_features, PLAYER_FEATURES),
    "player_features_whole": Query(player_features, PLAYER_FEATURES),
    "encoded_positions": Query(
        encoded_positions,
        oracle("""SELECT player_id, coalesce(position, 'Unknown') AS position,
                    CAST(dense_rank() OVER (ORDER BY coalesce(position, 'Unknown')) - 1 AS DOUBLE) AS position_enc
                  FROM g_players"""),
    ),
    "team_strength": Query(team_strength, oracle("SELECT * FROM strength")),
    "game_features": Query(
        game_features,
        oracle("""SELECT g.game_id, g.home_club_id, g.away_club_id, g.total_goals, g.attendance,
                    h.avg_goals_scored_home AS home_attack, h.avg_goals_conceded_home AS home_defense,
                    h.overall_attack AS home_overall_attack, h.overall_defense AS home_overall_defense,
                    a.avg_goals_scored_away AS away_attack, a.avg_goals_conceded_away AS away_defense,
                    a.overall_attack AS away_overall_attack, a.overall_defense AS away_overall_defense
                  FROM g_games g JOIN strength h ON h.club_id = g.home_club_id
                  JOIN strength a ON a.club_id = g.away_club_id
                  WHERE g.competition_type = 'domestic_league'"""),
    ),
    "found_clubs": Query(
        found_clubs,
        oracle(" UNION ALL ".join(
            f"""SELECT * FROM (SELECT '{p}' AS pattern, club_name, club_id FROM strength
                WHERE regexp_matches(club_name, '{p}', 'i') ORDER BY club_name, club_id LIMIT 1)"""
            for p in ("team 1", "TEAM 2[0-9]", "9 FC", "nowhere")
        )),
    ),
    "held_out_games": Query(held_out_games, "SELECT true AS a_fifth, true AS same"),
    "player_model_metrics": Query(player_model_metrics),
    "player_model_importances": Query(player_model_importances),
    "value_potential": Query(value_potential),
    "goals_model_metrics": Query(goals_model_metrics),
    "fixture_predictions": Query(fixture_predictions),
}
