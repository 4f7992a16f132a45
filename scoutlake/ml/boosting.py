"""What the two models share: split, fit, evaluate, rank features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from scoutlake.session import ensure_checkpoints


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    features: tuple[str, ...]
    label: str

    def metrics(self, **parts: DataFrame) -> DataFrame:
        """Mean absolute error and R² per named part, e.g. held-out and training rows: one pass each."""
        label = F.col(self.label).cast("double")
        error = label - F.col("prediction")
        spread = F.nullif(F.var_pop(label) * F.count(label), F.lit(0.0))
        lines = [
            self.model.transform(df).agg(
                F.avg(F.abs(error)).alias("mae"), (1 - F.sum(error * error) / spread).alias("r2")
            ).select(F.lit(name).alias("part"), F.stack(F.lit(2), F.lit("mae"), "mae", F.lit("r2"), "r2").alias("metric", "value"))
            for name, df in parts.items()
        ]
        return reduce(DataFrame.unionByName, lines)

    def importances(self, spark, n: int = 5) -> DataFrame:
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = [(f, float(w)) for f, w in zip(self.features, weights)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        ).limit(n)


def split_by_key(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(training, held-out) rows by a hash of the key: the same rows after any repartitioning."""
    part = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(10_000))
    held_out = part < int(test_share * 10_000)
    return df.filter(~held_out), df.filter(held_out)


def fit(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    trees: int,
    depth: int,
    step: float = 0.1,
    seed: int = 42,
    stages: Sequence = (),
) -> Trained:
    """The fitted pipeline. Every level of every tree is a job, whose tasks each answer to the driver, so there are no
    more tasks than cores, however many files the rows come from."""
    ensure_checkpoints(train.sparkSession)
    train = train.coalesce(train.sparkSession.sparkContext.defaultParallelism)
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    booster = GBTRegressor(
        featuresCol="_features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=seed
    )
    model = Pipeline(stages=[*stages, assembler, booster]).fit(train)
    return Trained(model, tuple(features), label)
