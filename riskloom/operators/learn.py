"""Training, search, scoring and keeping of classifiers with Spark ML.

Three boosted-tree slots and a forest stand for the learners they are named after. Each slot has its
own parameters and class weighting; the trees are Spark's, grown over all partitions.
"""

from __future__ import annotations

import functools
import itertools
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from riskloom.functions.features import FEATURE_NAMES
from riskloom.operators import evaluation, ranking
from riskloom.operators.ensemble import to_long
from riskloom.operators.penalised import PenalisedBoost, refit_leaves
from riskloom.operators.splits import stratified_folds
from riskloom.session import ensure_checkpoint_dir

WEIGHT = "weight"
SEED = 42


@dataclass(frozen=True)
class Slot:
    """A named learner: how it weighs classes and the parameters it takes."""

    kind: str
    weighting: str
    parameters: Mapping[str, object] = field(default_factory=dict)


# Learner parameters by role. ``featureSubsetStrategy`` stands for column sampling,
# ``minInstancesPerNode`` for minimum leaf size, ``l2_leaf_reg`` refits leaf values; leaf counts have no counterpart.
SLOTS = {
    "xgboost": Slot("boosted", "positive", {"maxIter": 300, "stepSize": 0.1, "maxDepth": 6}),
    "catboost": Slot("boosted", "balanced", {"maxIter": 300, "stepSize": 0.1, "maxDepth": 6}),
    "lightgbm": Slot("boosted", "balanced", {"maxIter": 300, "stepSize": 0.1, "maxDepth": 6, "maxBins": 64}),
    "random_forest": Slot(
        "forest",
        "balanced",
        {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"},
    ),
}
SCRIPT_SLOTS = {
    "xgboost": Slot(
        "boosted",
        "positive",
        {
            "maxIter": 500,
            "stepSize": 0.05,
            "maxDepth": 6,
            "minInstancesPerNode": 3,
            "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8",
        },
    ),
    "catboost": Slot("boosted", "balanced", {"maxIter": 500, "stepSize": 0.05, "maxDepth": 6}),
    "lightgbm": Slot(
        "boosted",
        "balanced",
        {
            "maxIter": 500,
            "stepSize": 0.05,
            "maxDepth": 6,
            "minInstancesPerNode": 20,
            "subsamplingRate": 0.8,
            "featureSubsetStrategy": "0.8",
        },
    ),
    "random_forest": SLOTS["random_forest"],
}
# Search grids.
GRIDS = {
    "catboost": {
        "maxIter": [100, 200, 300, 500],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "maxDepth": [4, 5, 6, 7, 8],
        "l2_leaf_reg": [1, 3, 5, 7],
    },
    "xgboost": {
        "maxIter": [100, 200, 300, 500],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "maxDepth": [3, 4, 5, 6, 7],
        "minInstancesPerNode": [1, 3, 5],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["0.7", "0.8", "0.9", "all"],
    },
    "lightgbm": {
        "maxIter": [100, 200, 300, 500],
        "stepSize": [0.01, 0.05, 0.1, 0.2],
        "maxDepth": [3, 4, 5, 6, 7],
        "minInstancesPerNode": [10, 20, 30, 50],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    },
    "random_forest": {
        "numTrees": [100, 200, 300, 500],
        "maxDepth": [5, 8, 10, 15, 30],
        "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "log2", "all"],
    },
}


# --- class weights ------------------------------------------------------------------------------


def with_class_weight(
    df: DataFrame, label: str = "is_default", mode: str = "balanced", counted: DataFrame | None = None
) -> DataFrame:
    """Append ``weight``, from the classes of ``counted`` if given: training rows without validation ones.

    ``positive`` weighs positives with negatives per positive (1 if there are none) and negatives
    with 1. ``balanced`` weighs a class with n / (2 n_class).
    """
    positive = F.col(label) == 1
    counts = (df if counted is None else counted).agg(
        F.struct(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")).alias("counts")
    ).scalar()
    pos, neg = F.col("_counts.pos"), F.col("_counts.neg")
    weights = {
        "positive": F.when(positive, F.coalesce(F.try_divide(neg, pos), F.lit(1.0))).otherwise(1.0),
        "balanced": F.try_divide(pos + neg, F.when(positive, pos).otherwise(neg) * 2),
    }
    if mode not in weights:
        raise ValueError(f"unknown class weighting: {mode}")
    return df.withColumn("_counts", counts).withColumn(WEIGHT, weights[mode]).drop("_counts")


# --- fitting and scoring ------------------------------------------------------------------------


def classifier(slot: Slot, label: str = "is_default", validation: str | None = None, **overrides: object):
    """The unfitted learner of a slot.

    With ``validation``, boosting stops when the error on the rows flagged there stops improving.
    """
    options = {k: v for k, v in {**slot.parameters, **overrides}.items() if k != "l2_leaf_reg"}
    common = {"labelCol": label, "featuresCol": "features", "weightCol": WEIGHT, "seed": SEED}
    if slot.kind == "forest":
        return RandomForestClassifier(**common, **options)
    if validation:
        common |= {"validationIndicatorCol": validation, "validationTol": 0.001}
    return GBTClassifier(**common, **options, checkpointInterval=10, cacheNodeIds=True)


def fit_slot(
    data: DataFrame, slot: Slot, label: str = "is_default", validation: str | None = None, **overrides: object
) -> Model:
    """Fit one learner on rows that carry a ``features`` vector.

    Lineage of long boosting runs is cut through the shared checkpoint folder.
    """
    ensure_checkpoint_dir(data.sparkSession)
    counted = data.filter(~F.col(validation)) if validation else None
    weighted = with_class_weight(data, label, slot.weighting, counted)
    needed = [label, "features", WEIGHT] + ([validation] if validation else [])
    penalty = overrides.pop("l2_leaf_reg", slot.parameters.get("l2_leaf_reg"))
    rows = weighted.select(*needed)
    fitted = classifier(slot, label, validation, **overrides).fit(rows)
    if penalty is None:
        return fitted
    return refit_leaves(fitted, rows.filter(~F.col(validation)) if validation else rows, float(penalty), label, WEIGHT)


def staged_losses(model: Model, data: DataFrame) -> list[float]:
    """The mean loss of a boosted model after each of its rounds, all in one pass over the rows."""
    return model.evaluateEachIteration(data.withColumn(WEIGHT, F.lit(1.0)))


def cut_at(model: Model, rounds: int) -> Model:
    """The boosted model that the first ``rounds`` rounds make."""
    java, context = model._java_obj, SparkContext._active_spark_context
    spark_ml = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(spark_ml.regression.DecisionTreeRegressionModel, rounds)
    weights = context._gateway.new_array(context._gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    made = spark_ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), 2)
    return GBTClassificationModel(java.copyValues(made, java.extractParamMap()))


@dataclass(frozen=True)
class Patient:
    """A model cut at its best round, the rounds that were fitted for it, and the loss after each of them."""

    model: Model
    fitted: int
    losses: tuple[float, ...]

    @property
    def best(self) -> int:
        """Rounds of the model that is kept."""
        return 1 + min(range(len(self.losses)), key=self.losses.__getitem__)


def fit_patiently(
    data: DataFrame, slot: Slot, validation: str, patience: int = 50, label: str = "is_default", **overrides: object
) -> Patient:
    """Boost until the loss on the validation rows has not improved for ``patience`` rounds, and keep the best round.

    Rows flagged by ``validation`` take no part in fitting. Spark fits a number of rounds at once; it starts with twice
    the patience and doubles until the best round lies far enough back or ``maxIter`` is reached. A longer run begins with the
    rounds of a shorter one, so nothing changes but the time, which is at most three times the last run's.
    """
    most = int(overrides.pop("maxIter", slot.parameters.get("maxIter", 100)))
    train, held_out = data.filter(~F.col(validation)), data.filter(F.col(validation))
    rounds = min(2 * patience, most)
    while True:
        model = fit_slot(train, slot, label, None, **overrides, maxIter=rounds)
        losses = tuple(staged_losses(model, held_out))
        found = Patient(model, len(losses), losses)
        if found.best + patience <= rounds or rounds == most:
            return Patient(cut_at(model, found.best), found.fitted, losses)
        rounds = min(2 * rounds, most)


def evenly_kept(data: DataFrame) -> DataFrame:
    """Persisted rows, rebalanced so that neither tiny nor swollen partitions are passed over again.

    Unless it may change the partitions of a cached plan, Spark keeps as many as a shuffle has, however few the rows.
    """
    spark, name = data.sparkSession, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        return data.hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        spark.conf.set(name, before)


def fit_all(
    data: DataFrame,
    slots: Mapping[str, Slot] = SLOTS,
    label: str = "is_default",
    validation: str | None = None,
    overrides: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, Model]:
    """Fit every slot on the same rows. Forests take no part in early stopping.

    The rows are kept in partitions of even, advised size: fitting passes over them many times.
    """
    kept = evenly_kept(data)
    try:
        return fit_kept(kept, slots, label, validation, overrides)
    finally:
        kept.unpersist()


def fit_kept(
    kept: DataFrame,
    slots: Mapping[str, Slot],
    label: str = "is_default",
    validation: str | None = None,
    overrides: Mapping[str, Mapping[str, object]] | None = None,
) -> dict[str, Model]:
    """:func:`fit_all` on rows the caller has persisted."""
    fitted = {}
    for name, slot in slots.items():
        rows, flag = kept, validation
        if slot.kind == "forest" and validation:
            rows, flag = kept.filter(~F.col(validation)), None
        fitted[name] = fit_slot(rows, slot, label, flag, **(overrides or {}).get(name, {}))
    return fitted


def score(df: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Append the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def score_all(df: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    """Append one probability column per model, in one pass over the rows."""
    for name, model in models.items():
        df = score(df, model, name)
    return df


def long_scores(scored: DataFrame, names: Sequence[str], key: str, label: str = "is_default") -> DataFrame:
    renamed = scored.select(F.col(key).alias("id"), F.col(label).alias("label"), *names)
    return to_long(renamed, names, ["id", "label"])


# --- judging ------------------------------------------------------------------------------------


def validation_auc(scored: DataFrame, names: Sequence[str], key: str, label: str = "is_default") -> DataFrame:
    """AUC per model on validation rows, best first."""
    areas = evaluation.roc_auc(long_scores(scored, names, key, label))
    return areas.withColumnRenamed("roc_auc", "val_roc_auc").orderBy(F.desc("val_roc_auc"), "model")


def evaluate_and_compare(
    scored: DataFrame, names: Sequence[str], key: str, label: str = "is_default", threshold: float = 0.5
) -> DataFrame:
    """The evaluation row of every model with its rank by AUC."""
    return ranking.compare_models(evaluation.evaluate(long_scores(scored, names, key, label), threshold))


def importances(model: Model, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """Importance per feature; generic names when their number does not fit."""
    values = model.featureImportances.toArray().tolist()
    labels = names if len(names) == len(values) else [f"feature_{i}" for i in range(len(values))]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(labels, values, strict=True)), "feature string, importance double")


def uniform_importances(spark: SparkSession, names: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """What a learner without importances reports: the same share for each feature."""
    share = F.lit(1.0 / len(names)) if names else F.lit(None).cast("double")
    listed = F.explode(F.array(*map(F.lit, names)).cast("array<string>"))
    return spark.range(1).select(listed.alias("feature"), share.alias("importance"))


# --- search -------------------------------------------------------------------------------------


def draw(grid: Mapping[str, Sequence[object]], n: int, seed: int = SEED) -> list[dict[str, object]]:
    """``n`` different points of a grid, or all of them if it has no more."""
    points = [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, min(n, len(points)))


def search(
    data: DataFrame,
    name: str,
    n_iter: int = 20,
    folds: int = 3,
    key: str = "c_custkey",
    label: str = "is_default",
    grid: Mapping[str, Sequence[object]] | None = None,
    parallelism: int = 3,
) -> tuple[Model, dict[str, object], DataFrame]:
    """Randomised search by cross-validated F1: refitted best model, its parameters, all trials.

    Fits do not depend on each other; ``parallelism`` of them run at a time.

    A trial's held-out scores from all folds are judged together per fold in one aggregation; what
    reaches the driver is one number per trial.
    """
    slot, grid = SLOTS[name], grid or GRIDS[name]
    spark = data.sparkSession
    folded = evenly_kept(stratified_folds(data, key, label, folds, str(SEED)))

    def one_fold(point: Mapping[str, object], fold: int) -> DataFrame:
        model = fit_slot(folded.filter(F.col("fold") != fold), slot, label, **point)
        return score(folded.filter(F.col("fold") == fold), model).select(
            F.col("fold").cast("string").alias("model"), F.col(label).alias("label"), "score"
        )

    trials = []
    try:
        points = draw(grid, n_iter)
        with ThreadPoolExecutor(parallelism) as pool:
            fitted = [
                [pool.submit(inheritable_thread_target(spark)(one_fold), point, fold) for fold in range(folds)] for point in points
            ]
            for number, (point, parts) in enumerate(zip(points, fitted, strict=True)):
                held_out = functools.reduce(DataFrame.unionByName, [part.result() for part in parts])
                f1 = evaluation.at_threshold(held_out, 0.5).agg(F.avg("f1")).first()[0]
                trials.append((name, number, {k: str(v) for k, v in point.items()}, float(f1 or 0.0), point))
        best = max(trials, key=lambda t: (t[3], -t[1]))
        model = fit_slot(folded, slot, label, **best[4])
    finally:
        folded.unpersist()
    schema = "model string, trial int, params map<string,string>, cv_f1 double"
    return model, best[4], spark.createDataFrame([t[:4] for t in trials], schema)


def best_trials(trials: DataFrame) -> DataFrame:
    """Best parameters and score per model, the earlier trial on ties."""
    best = F.max(F.struct("cv_f1", (-F.col("trial")).alias("order"), F.to_json("params").alias("params")))
    return trials.groupBy("model").agg(best.alias("best")).select("model", "best.params", "best.cv_f1")


# --- keeping ------------------------------------------------------------------------------------

_READERS = {"boosted": GBTClassificationModel, "forest": RandomForestClassificationModel}


def save_models(models: Mapping[str, Model], folder: str) -> None:
    for name, model in models.items():
        if isinstance(model, PenalisedBoost):
            model.save(f"{folder}/{name}", SparkSession.getActiveSession())
        else:
            model.write().overwrite().save(f"{folder}/{name}")


def _loaded(slot: Slot, folder: str) -> Model:
    if slot.kind == "boosted":
        try:
            return PenalisedBoost.load(folder, SparkSession.getActiveSession())
        except AnalysisException:
            pass  # no leaf values beside it: a plain model
    return _READERS[slot.kind].load(folder)


def load_models(folder: str, slots: Mapping[str, Slot] = SLOTS) -> dict[str, Model]:
    """Every model that can be loaded; the rest are skipped, and none at all is an error."""
    loaded, problems = {}, []
    for name, slot in slots.items():
        try:
            loaded[name] = _loaded(slot, f"{folder}/{name}")
        except Exception as error:  # a missing or broken model must not stop the others
            problems.append(f"{name}: {type(error).__name__}")
    if not loaded:
        raise ValueError(f"no model could be loaded from {folder} ({', '.join(problems)})")
    return loaded
