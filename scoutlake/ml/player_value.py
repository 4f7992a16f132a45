"""Peak value of a player from age, position and output."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, functions as F

from scoutlake.functions import in_millions, per_90, ratio_or_zero
from scoutlake.ml.boosting import Trained, fit, split_by_key
from scoutlake.ml.model_store import fit_once
from scoutlake.operators.aggregates import fill_median
from scoutlake.operators.ranges import stored_parts
from scoutlake.operators.relational import drop_incomplete, top_n

# Model inputs and target. The last feature is made from the target.
FEATURES = (
    "age", "position_enc", "total_goals", "total_assists", "total_minutes", "total_appearances",
    "goals_per_90", "assists_per_90", "ga_per_90", "minutes_per_appearance", "cards_per_90", "height_in_cm",
)
LEAKING_FEATURE = "value_ratio"
TARGET = "highest_market_value_in_eur"


def player_features(players: DataFrame, impute_height: bool = False) -> DataFrame:
    """Players with a value, an age and minutes, and the features of the model.

    Rows without a height are left out, or take the median with `impute_height`.
    """
    known = players.filter(
        (F.col("market_value_in_eur") > 0) & F.col("age").isNotNull() & (F.col("total_minutes") > 0)
    )

    def rate(column: str):
        return F.coalesce(per_90(column, "total_minutes"), F.lit(0.0))

    df = known.withColumns(
        {
            "goals_per_90": rate("total_goals"),
            "assists_per_90": rate("total_assists"),
            "minutes_per_appearance": ratio_or_zero("total_minutes", "total_appearances"),
            LEAKING_FEATURE: ratio_or_zero("market_value_in_eur", TARGET),
            "cards_per_90": F.coalesce(per_90(F.col("total_yellow") + F.col("total_red"), "total_minutes"), F.lit(0.0)),
            "position": F.coalesce("position", F.lit("Unknown")),
        }
    ).withColumn("ga_per_90", F.col("goals_per_90") + F.col("assists_per_90"))
    if impute_height:
        df = fill_median(df, "height_in_cm")
    inputs = [c for c in FEATURES if c != "position_enc"]
    return drop_incomplete(df, [*inputs, LEAKING_FEATURE, TARGET])


def train_player_value(
    features: DataFrame, trees: int = 200, depth: int = 6, step: float = 0.1, seed: int = 42, leak: bool = False,
    store: str | None = None,
) -> tuple[Trained, DataFrame, DataFrame]:
    """The model with its training and held-out rows. `leak` adds the feature made from the target.

    With a `store` folder the model is fitted once for equal rows and settings, and its rows are stored too: key, split
    points, fit and scores pass over them, and would each derive them anew.
    """
    if store is not None:
        features = stored_parts(features, "features")
    train, held_out = split_by_key(features, "player_id", seed=seed)
    names = (*FEATURES, LEAKING_FEATURE) if leak else FEATURES
    position = StringIndexer(
        inputCol="position", outputCol="position_enc", stringOrderType="alphabetAsc", handleInvalid="keep"
    )

    def fitted() -> Trained:
        return fit(train, names, TARGET, trees, depth, step, seed, [position])

    if store is None:
        return fitted(), train, held_out
    columns = [c for c in names if c != "position_enc"] + ["position", TARGET]
    settings = {"model": "player_value", "trees": trees, "depth": depth, "step": step, "seed": seed, "names": names}
    return fit_once(store, train, columns, settings, fitted, names, TARGET), train, held_out


def value_potential(
    trained: Trained,
    features: DataFrame,
    max_age: int = 23,
    max_value: float = 1e7,
    min_minutes: int = 1000,
    n: int = 15,
) -> DataFrame:
    """Young, affordable regulars by predicted upside in percent."""
    value, predicted = F.col("market_value_in_eur"), F.col("prediction")
    scored = trained.model.transform(features).withColumn("_upside_pct", (predicted - value) / value * 100)
    young = (F.col("age") <= max_age) & (F.col("total_minutes") >= min_minutes) & (value <= max_value)
    top = top_n(scored.filter(young & (predicted > value)), "_upside_pct", n, tie_break=["player_id"])
    return top.select(
        "player_id",
        "name",
        "age",
        "position",
        in_millions(value, 2).alias("value_m"),
        in_millions(predicted, 2).alias("predicted_m"),
        F.round("_upside_pct", 1).alias("upside_pct"),
    )
