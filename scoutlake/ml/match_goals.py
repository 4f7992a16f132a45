"""Goals of a match from the strength of both clubs, and predictions for fixtures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from scoutlake.contracts import DOMESTIC_LEAGUE
from scoutlake.functions import contains_ci, expected_goals, score_goals, tendency
from scoutlake.ml.boosting import Trained, fit, split_by_key
from scoutlake.ml.model_store import fit_once
from scoutlake.operators.aggregates import home_away_strength, with_means
from scoutlake.operators.ranges import stored_parts
from scoutlake.operators.relational import drop_incomplete, role_join

# Model inputs, per role, and the strength column behind each.
HOME_ROLE = {
    "home_attack": "avg_goals_scored_home",
    "home_defense": "avg_goals_conceded_home",
    "home_overall_attack": "overall_attack",
    "home_overall_defense": "overall_defense",
}
AWAY_ROLE = {
    "away_attack": "avg_goals_scored_away",
    "away_defense": "avg_goals_conceded_away",
    "away_overall_attack": "overall_attack",
    "away_overall_defense": "overall_defense",
}
FEATURES = (*HOME_ROLE, *AWAY_ROLE)
TARGET = "total_goals"
# League games in each role that a club needs for a strength.
MIN_GAMES = 10


def team_strength(games: DataFrame, min_games: int = MIN_GAMES, stored: bool = False) -> DataFrame:
    """League strengths; `stored` ones are written down for several readers."""
    strength = home_away_strength(games, min_games, F.col("competition_type") == DOMESTIC_LEAGUE)
    return stored_parts(strength, "strength") if stored else strength


def game_features(games: DataFrame, strength: DataFrame) -> DataFrame:
    """League games of clubs with a known strength, with the eight features."""
    league = games.filter((F.col("competition_type") == DOMESTIC_LEAGUE) & F.col(TARGET).isNotNull())
    narrow = league.select("game_id", "home_club_id", "away_club_id", TARGET, "attendance")
    both = role_join(narrow, strength, "club_id", {"home_club_id": HOME_ROLE, "away_club_id": AWAY_ROLE})
    return drop_incomplete(both, [*FEATURES, TARGET])


def train_match_goals(
    features: DataFrame, trees: int = 150, depth: int = 4, step: float = 0.1, seed: int = 42, store: str | None = None
) -> tuple[Trained, DataFrame, DataFrame]:
    """The model with its training and held-out rows; with a `store` folder it is fitted once for equal rows and settings.

    The rows are stored too then: key, split points, fit and scores pass over them, and would each derive them anew.
    """
    if store is not None:
        features = stored_parts(features, "features")
    train, held_out = split_by_key(features, "game_id", seed=seed)

    def fitted() -> Trained:
        return fit(train, FEATURES, TARGET, trees, depth, step, seed)

    if store is None:
        return fitted(), train, held_out
    settings = {"model": "match_goals", "trees": trees, "depth": depth, "step": step, "seed": seed}
    return fit_once(store, train, [*FEATURES, TARGET], settings, fitted, FEATURES, TARGET), train, held_out


def find_clubs(strength: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The first club by name, then id, per pattern that occurs in its name, in any case.

    One pass over the clubs: every club is expanded into the patterns it matches,
    so nothing is emitted for the others and no join condition is needed.
    """
    wanted = F.array(*(F.lit(p) for p in dict.fromkeys(patterns)))
    hits = F.filter(wanted, lambda p: contains_ci(F.col("club_name"), p))
    fields = [c for c in strength.columns if c not in ("club_name", "club_id")]
    found = strength.select(
        F.explode(hits).alias("pattern"), F.struct("club_name", "club_id", *fields).alias("club")
    )
    return found.groupBy("pattern").agg(F.min("club").alias("club"))


def predict_fixtures(
    trained: Trained, strength: DataFrame, fixtures: Sequence[tuple[str, str]]
) -> DataFrame:
    """Predicted goals, expected goals per side, likeliest score and kind of game per fixture.

    A fixture whose club is unknown gets a status and nulls.
    """
    spark = strength.sparkSession
    rows = [(i, home, away) for i, (home, away) in enumerate(fixtures)]
    pairs = spark.createDataFrame(rows, "fixture int, home string, away string")
    means = {
        "_mean_away": "avg_goals_conceded_away",
        "_mean_home": "avg_goals_conceded_home",
    }
    clubs = find_clubs(strength, [name for pair in fixtures for name in pair])
    home = clubs.select(F.col("pattern").alias("home"), F.col("club").alias("h"))
    away = clubs.select(F.col("pattern").alias("away"), F.col("club").alias("a"))
    both = pairs.join(home, "home", "left").join(away, "away", "left")
    known = with_means(both.filter(F.col("h").isNotNull() & F.col("a").isNotNull()), means, strength)
    inputs = {f: F.col(f"h.{c}") for f, c in HOME_ROLE.items()} | {f: F.col(f"a.{c}") for f, c in AWAY_ROLE.items()}
    scored = trained.model.transform(known.withColumns(inputs)).withColumns(
        {
            "_home": expected_goals("home_attack", "a.avg_goals_conceded_away", "_mean_away"),
            "_away": expected_goals("away_attack", "h.avg_goals_conceded_home", "_mean_home"),
        }
    )
    result = scored.select(
        "fixture",
        F.round("prediction", 1).alias("predicted_goals"),
        F.round("_home", 1).alias("expected_home"),
        F.round("_away", 1).alias("expected_away"),
        F.concat_ws("-", score_goals("_home"), score_goals("_away")).alias("likely_score"),
        tendency("prediction").alias("tendency"),
    )
    status = (
        F.when(F.col("h").isNull(), F.concat(F.lit("club not found: "), "home"))
        .when(F.col("a").isNull(), F.concat(F.lit("club not found: "), "away"))
        .otherwise("predicted")
    )
    named = both.select(
        "fixture", "home", "away", F.col("h.club_name").alias("home_club"), F.col("a.club_name").alias("away_club"),
        status.alias("status"),
    )
    return named.join(result, "fixture", "left").orderBy("fixture")
