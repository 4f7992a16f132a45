"""Fitted models kept by the content they were fitted on, and their trees as a table.

`fit_once` names a model by a digest of its training rows, their schema and the settings, so equal
training rows in any order find the model of an earlier run, on any machine that sees the folder.
`tree_table` gives the nodes of a boosted model as rows, and `tree_scores` walks them by joins: scores
that need no model object, and an independent check of the model's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from scoutlake.functions.hashing import content_hash, schema_text
from scoutlake.ml.boosting import Trained
from scoutlake.sources import versions

# Part of every key: raise it when a change of the training makes kept models out of date.
FORM = 1


def model_key(train: DataFrame, columns: Sequence[str], settings: Mapping[str, object]) -> str:
    """Digest of the training rows (as a multiset), the columns that are learned from, and the settings."""
    rows = train.select(*sorted(set(columns)))
    content = content_hash(rows).first()
    parts = (FORM, content["rows"], content["content_hash"], schema_text(rows), sorted(settings.items()))
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def fit_once(
    store: str, train: DataFrame, columns: Sequence[str], settings: Mapping[str, object], fit: Callable[[], Trained],
    features: Sequence[str], label: str,
) -> Trained:
    """The kept model of these rows and settings, or a new one from `fit`, which is then kept.

    A model is listed only when it is written whole. Two runs that miss at the same time both fit; the later one is listed.
    """
    spark = train.sparkSession
    key = model_key(train, columns, settings)
    found = versions.published(spark, store).get(key)
    if found:
        return Trained(PipelineModel.load(found), tuple(features), label)
    trained = fit()
    folder = f"{versions.new_folder(store)}/{key}"
    trained.model.save(folder)
    versions.publish(spark, store, {key: folder})
    return trained


def tree_table(spark: SparkSession, trained: Trained, folder: str) -> DataFrame:
    """(tree, weight, node, feature, threshold, categories, left, right, prediction) of the booster, written below `folder`.

    A leaf has no children (-1). A split sends values up to `threshold` to the left, or those in `categories`.
    """
    trained.model.stages[-1].save(folder)
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("tree", "params", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{folder}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    values, numeric = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories") < 0
    return nodes.join(weights, "tree").select(
        "tree", "weight", F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.when(numeric, F.get(values, F.lit(0))).alias("threshold"),
        F.when(~numeric, values).alias("categories"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), "prediction",
    )


def tree_scores(trained: Trained, df: DataFrame, key: str, nodes: DataFrame) -> DataFrame:
    """(key, tree_score): every row walks all trees level by level; `key` is unique and not null.

    The node table is broadcast: it has at most trees x 2^(depth + 1) rows, however many rows are scored. The
    walk is one stage without a shuffle; only the sum per row is grouped, and a row's parts are summed map-side.
    """
    booster = trained.model.stages[-1]
    inputs = PipelineModel(trained.model.stages[:-1]).transform(df)
    trees = F.explode(F.sequence(F.lit(0), F.lit(booster.getNumTrees - 1)))
    walk = inputs.select(key, vector_to_array("_features").alias("x"), trees.alias("tree"), F.lit(0).alias("node"))
    value = F.get("x", F.col("feature"))
    goes_left = F.coalesce(F.array_contains("categories", value), value <= F.col("threshold"))
    following = F.when(F.col("left") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
    table = F.broadcast(nodes)
    for _ in range(booster.getMaxDepth()):
        walk = walk.join(table, ["tree", "node"]).select(key, "x", "tree", following.alias("node"))
    leaves = walk.join(table, ["tree", "node"])
    return leaves.groupBy(key).agg(F.sum(F.col("weight") * F.col("prediction")).alias("tree_score"))
