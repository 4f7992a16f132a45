import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from scoutlake.contracts import GOLD
from scoutlake.ml import boosting, match_goals, model_store, player_value
from scoutlake.ml.boosting import split_by_key


@pytest.fixture(scope="module")
def players(spark):
    rng = random.Random(1)
    data = []
    for i in range(400):
        goals, minutes = rng.randint(0, 30), rng.randint(0, 3000)
        value = (goals + 1) * 200_000.0
        row = dict(
            player_id=str(i), name=f"P{i}", age=rng.randint(17, 34), position=rng.choice(["Attack", "Defender", None]),
            height_in_cm=None if i % 9 == 0 else 180.0 + rng.randint(0, 20), market_value_in_eur=value,
            highest_market_value_in_eur=value * 2, total_goals=goals, total_assists=2, total_yellow=1,
            total_red=0, total_minutes=minutes, total_appearances=minutes // 80,
        )
        data.append(tuple(row.get(c) for c in GOLD["players"].fieldNames()))
    return spark.createDataFrame(data, GOLD["players"]).cache()


def test_player_features(players):
    features = player_value.player_features(players)
    assert features.filter("height_in_cm is null or total_minutes = 0").count() == 0
    assert features.filter("position = 'Unknown'").count() > 0
    filled = player_value.player_features(players, impute_height=True)
    assert filled.count() == players.filter("total_minutes > 0").count()
    row = features.first()
    assert row.goals_per_90 == pytest.approx(row.total_goals / row.total_minutes * 90)
    assert row.ga_per_90 == row.goals_per_90 + row.assists_per_90


def test_player_value_model_beats_the_mean(spark, players):
    features = player_value.player_features(players).cache()
    trained, train, held_out = player_value.train_player_value(features, trees=8, depth=4, step=0.3)
    metrics = {(r.part, r.metric): r.value for r in trained.metrics(train=train, held_out=held_out).collect()}
    assert metrics["held_out", "r2"] > 0.2 and metrics["train", "mae"] > 0
    scored = trained.model.transform(held_out)
    for metric in ("mae", "r2"):
        evaluator = RegressionEvaluator(labelCol=player_value.TARGET, metricName=metric)
        assert metrics["held_out", metric] == pytest.approx(evaluator.evaluate(scored))
    ranked = trained.importances(spark).collect()
    assert len(ranked) == 5 and ranked[0].importance >= ranked[-1].importance and ranked[0].feature == "total_goals"
    top = player_value.value_potential(trained, features).collect()
    assert 0 < len(top) <= 15
    assert all(r.age <= 23 and r.value_m <= 10 and r.upside_pct > 0 for r in top)
    assert [r.upside_pct for r in top] == sorted((r.upside_pct for r in top), reverse=True)
    leaking, *_ = player_value.train_player_value(features, trees=2, depth=2, leak=True)
    assert player_value.LEAKING_FEATURE in leaking.features and player_value.LEAKING_FEATURE not in trained.features


def test_split_is_stable_and_disjoint(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    train, held_out = split_by_key(df, "k")
    assert train.count() + held_out.count() == 2000 and 300 < held_out.count() < 500
    again = {r.k for r in split_by_key(df.repartition(7), "k")[1].collect()}
    assert {r.k for r in held_out.collect()} == again


@pytest.fixture(scope="module")
def games(spark):
    rng = random.Random(2)
    names = ["FC Bayern", "Dortmund", "Bayern II", "Inter", "Napoli"]
    data = []
    for i in range(400):
        home, away = rng.sample(range(5), 2)
        scored, conceded = rng.randint(0, 2) + (3 if home == 0 else 0), rng.randint(0, 2)
        row = dict(
            game_id=str(i), competition_type="domestic_league" if i % 10 else "domestic_cup", home_club_id=str(home),
            away_club_id=str(away), home_club_name=names[home], away_club_name=names[away], home_club_goals=scored,
            away_club_goals=conceded, total_goals=scored + conceded, attendance=100,
        )
        data.append(tuple(row.get(c) for c in GOLD["games"].fieldNames()))
    return spark.createDataFrame(data, GOLD["games"]).cache()


def test_match_goals_model_and_fixtures(games):
    strength = match_goals.team_strength(games).cache()
    assert strength.count() == 5
    features = match_goals.game_features(games, strength)
    assert features.count() == games.filter("competition_type = 'domestic_league'").count()
    trained, train, held_out = match_goals.train_match_goals(features, trees=8, depth=3)
    metrics = {(r.part, r.metric): r.value for r in trained.metrics(train=train, held_out=held_out).collect()}
    assert metrics["held_out", "r2"] > 0.2
    fixtures = [("fc bayern", "DORTMUND"), ("Bayern", "Inter"), ("Nobody", "Inter"), ("Inter", "Nobody")]
    rows = match_goals.predict_fixtures(trained, strength, fixtures).collect()
    assert [r.status for r in rows] == ["predicted", "predicted", "club not found: Nobody", "club not found: Nobody"]
    assert [r.home_club for r in rows] == ["FC Bayern", "Bayern II", None, "Inter"]
    first = rows[0]
    by_name = {r.club_name: r for r in strength.collect()}
    bayern, dortmund = by_name["FC Bayern"], by_name["Dortmund"]
    means = [sum(r[c] for r in by_name.values()) / 5 for c in ("avg_goals_conceded_away", "avg_goals_conceded_home")]
    assert first.expected_home == pytest.approx(
        bayern.avg_goals_scored_home * dortmund.avg_goals_conceded_away / means[0], abs=0.051
    )
    assert first.expected_away == pytest.approx(
        dortmund.avg_goals_scored_away * bayern.avg_goals_conceded_home / means[1], abs=0.051
    )
    assert first.tendency in ("open", "balanced") and first.likely_score.count("-") == 1
    assert rows[2].predicted_goals is None


def test_models_are_fitted_once_and_scored_by_their_trees(spark, players, tmp_path, monkeypatch):
    features = player_value.player_features(players)
    store, fits = f"{tmp_path}/models", []
    fit = player_value.fit
    monkeypatch.setattr(player_value, "fit", lambda *args: fits.append(1) or fit(*args))
    sizes = {"trees": 5, "depth": 3, "step": 0.3, "store": store}
    first, *_ = player_value.train_player_value(features, **sizes)
    # Equal rows in another order find the kept model; other settings or other rows do not.
    again, _, held_out = player_value.train_player_value(features.repartition(5), **sizes)
    assert len(fits) == 1 and again.features == first.features and again.label == first.label
    player_value.train_player_value(features, **{**sizes, "trees": 2})
    player_value.train_player_value(features.unionAll(features.limit(1)), **sizes)
    assert len(fits) == 3
    nodes = model_store.tree_table(spark, again, f"{tmp_path}/trees").cache()
    assert nodes.select("tree").distinct().count() == 5 and nodes.filter("categories is not null").count() > 0
    scores = {r.player_id: r.tree_score for r in model_store.tree_scores(again, held_out, "player_id", nodes).collect()}
    own = {r.player_id: r.prediction for r in first.model.transform(held_out).collect()}
    assert scores == pytest.approx(own) and len(own) > 20
    assert model_store.tree_scores(again, held_out.limit(0), "player_id", nodes).count() == 0
    weights = first.importances(spark, len(first.features)).collect()
    assert sum(r.importance for r in weights) == pytest.approx(1)


def test_registered_models_are_those_of_the_operators(monkeypatch):
    """The queries pass no sizes of their own, so the operators' 200 x 6 and 150 x 4 hold."""
    from scoutlake.registry import models

    seen = {}

    def train(name, found):
        def record(features, *sizes, **named):
            assert set(named) <= {"store"}
            seen[name] = (sizes, {})
            return None, None, None

        monkeypatch.setattr(found, name, record)

    train("train_player_value", player_value)
    train("train_match_goals", match_goals)
    for module, name in ((models.gold, "players"), (models.gold, "games")):
        monkeypatch.setattr(module, name, lambda *_: _Cached())
    for module, name in ((player_value, "player_features"), (match_goals, "team_strength"), (match_goals, "game_features")):
        monkeypatch.setattr(module, name, lambda *_: _Cached())
    monkeypatch.setattr(models, "_store", lambda _: "kept")
    models._player_model(None, "")
    models._goals_model(None, "")
    assert seen == {"train_player_value": ((), {}), "train_match_goals": ((), {})}


class _Cached:
    def cache(self):
        return self


def test_fit_has_no_more_tasks_than_cores(spark, monkeypatch):
    seen = []
    fit = boosting.Pipeline.fit
    monkeypatch.setattr(boosting.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    df = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y")).repartition(40)
    boosting.fit(df, ["x"], "y", trees=1, depth=1)
    assert seen == [spark.sparkContext.defaultParallelism]
