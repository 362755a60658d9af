"""Leaf penalties for boosted trees: leaf values refitted as Newton steps, kept beside Spark's model.

Spark grows the trees; what a leaf adds to the log-odds is worked out anew, tree after tree, as the sum of
gradients over the sum of curvatures plus a penalty, each from one grouped aggregation over leaf numbers. A
tree's leaves, at most two to the power of its depth, are all that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir

#: Trees whose values are carried as an expression before the log-odds are written down.
CARRIED = 10
_LEAVES = "_leaves"


def _with_leaves(model: GBTClassificationModel, data: DataFrame) -> DataFrame:
    """Append the number of the leaf that a row reaches in each tree."""
    numbered = model.copy()
    numbered.setLeafCol(_LEAVES)
    found = numbered.transform(data)
    return found.select(*data.columns, vector_to_array(_LEAVES).cast("array<int>").alias(_LEAVES))


def _added(values: Sequence[float], rate: float, tree: int) -> Column:
    return F.get(F.lit(list(values)), F.get(_LEAVES, F.lit(tree))) * F.lit(rate)


def _probability(log_odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-log_odds))


@dataclass(frozen=True)
class PenalisedBoost:
    """Spark's trees with leaf values of their own."""

    model: GBTClassificationModel
    values: tuple[tuple[float, ...], ...]

    @property
    def rates(self) -> list[float]:
        """What each tree's values are multiplied by: 1 for the first, then the step size."""
        return list(self.model.treeWeights)

    @property
    def featureImportances(self):  # noqa: N802
        return self.model.featureImportances

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return self.model.getNumTrees

    def transform(self, data: DataFrame) -> DataFrame:
        """Append the vector ``probability`` of both classes."""
        trees = F.arrays_zip(F.lit([list(v) for v in self.values]).alias("values"), F.col(_LEAVES).alias("leaf"), F.lit(self.rates).alias("rate"))
        log_odds = F.aggregate(trees, F.lit(0.0), lambda total, t: total + F.get(t["values"], t["leaf"]) * t["rate"])
        scored = _with_leaves(self.model, data).withColumn("_p", _probability(log_odds))
        return scored.select(*data.columns, array_to_vector(F.array(1.0 - F.col("_p"), "_p")).alias("probability"))

    def save(self, folder: str, spark: SparkSession) -> None:
        self.model.write().overwrite().save(f"{folder}/trees")
        rows = [(i, list(v)) for i, v in enumerate(self.values)]
        spark.createDataFrame(rows, "tree int, leaf_values array<double>").coalesce(1).write.mode("overwrite").parquet(f"{folder}/leaves")

    @staticmethod
    def load(folder: str, spark: SparkSession) -> PenalisedBoost:
        rows = sorted(spark.read.parquet(f"{folder}/leaves").collect())
        return PenalisedBoost(GBTClassificationModel.load(f"{folder}/trees"), tuple(tuple(r["leaf_values"]) for r in rows))


def refit_leaves(
    model: GBTClassificationModel, data: DataFrame, penalty: float, label: str = "is_default", weight: str = "weight"
) -> PenalisedBoost:
    """Newton steps ``sum(w (y - p)) / (sum(w p (1 - p)) + penalty)`` per leaf, at the log-odds of the trees before.

    ``data`` has the columns the model was fitted on. A leaf without rows, or without curvature and penalty, adds nothing.
    """
    ensure_checkpoint_dir(data.sparkSession)
    rows = _with_leaves(model, data).select(
        F.col(label).cast("double").alias("y"), F.col(weight).cast("double").alias("w"), _LEAVES, F.lit(0.0).alias("log_odds")
    )
    rows = rows.checkpoint()
    values: list[tuple[float, ...]] = []
    log_odds = F.col("log_odds")
    for tree, (grown, rate) in enumerate(zip(model.trees, model.treeWeights)):
        p = _probability(log_odds)
        sums = rows.groupBy(F.get(_LEAVES, F.lit(tree)).alias("leaf")).agg(
            F.sum(F.col("w") * (F.col("y") - p)).alias("slope"), F.sum(F.col("w") * p * (1.0 - p)).alias("curve")
        )
        steps = {r["leaf"]: r["slope"] / (r["curve"] + penalty) if r["curve"] + penalty > 0 else 0.0 for r in sums.collect()}
        values.append(tuple(steps.get(leaf, 0.0) for leaf in range((grown.numNodes + 1) // 2)))
        log_odds = log_odds + _added(values[-1], rate, tree)
        if (tree + 1) % CARRIED == 0:
            rows, log_odds = rows.withColumn("log_odds", log_odds).checkpoint(), F.col("log_odds")
    return PenalisedBoost(model, tuple(values))
