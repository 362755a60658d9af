"""The training job: features, scaling, split, fitting, comparison, and what it leaves behind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import features
from riskloom.functions.features import CATEGORICAL_FEATURES, FEATURE_NAMES
from riskloom.operators import evaluation, isolation, learn, matrix, metrics, splits
from riskloom.operators.ensemble import to_long
from riskloom.sources import tables


@dataclass(frozen=True)
class Trained:
    """Models with the scored test rows and their comparison."""

    models: Mapping[str, Model]
    forest: isolation.IsolationForest | None
    test_scores: DataFrame
    comparison: DataFrame


def prepare(train: DataFrame, test: DataFrame, key: str, label: str = "is_default") -> tuple[DataFrame, DataFrame]:
    """Featured, scaled and assembled matrices, the training one with a validation flag."""
    parts = matrix.prepare_train_test(
        features.add_features(train), features.add_features(test), label, [key]
    )
    train_rows, test_rows = (matrix.assemble(p, FEATURE_NAMES) for p in parts)
    flagged = splits.validation_split(train_rows, key, label)
    return flagged.withColumn("is_validation", F.col("split") == "validation").drop("split"), test_rows


def anomaly_scores(
    train: DataFrame, test: DataFrame, key: str, label: str, trees: int
) -> tuple[isolation.IsolationForest, DataFrame]:
    """Isolation forest on normal training rows and its probability-like scores on the test rows."""
    forest = isolation.fit(train, FEATURE_NAMES, key, label, trees)
    raw = isolation.score(test, forest).checkpoint()  # the bounds and the result both read it
    return forest, metrics.anomaly_probability(raw, "raw_score").withColumnRenamed(
        "anomaly_score", "isolation_forest"
    )


def train_models(
    train: DataFrame,
    test: DataFrame,
    key: str,
    label: str = "is_default",
    slots: Mapping[str, learn.Slot] = learn.SLOTS,
    overrides: Mapping[str, Mapping[str, object]] | None = None,
    anomaly_trees: int = 200,
    threshold: float = 0.5,
) -> Trained:
    """Fit every slot and the isolation forest, score the test rows, and rank by AUC."""
    train_rows, test_rows = prepare(train, test, key, label)
    kept = learn.evenly_kept(train_rows)
    models = learn.fit_kept(kept, slots, label, "is_validation", overrides)
    scored, names, forest = learn.score_all(test_rows, models), list(models), None
    if anomaly_trees:
        learned = kept.filter(~F.col("is_validation"))
        forest, scored = anomaly_scores(learned, scored, key, label, anomaly_trees)
        names.append("isolation_forest")
    # Scores are kept once; evaluation reads them several times and the trees are dear to walk.
    scores = scored.select(key, label, *names).checkpoint()
    kept.unpersist()
    comparison = learn.evaluate_and_compare(scores, names, key, label, threshold)
    return Trained(models, forest, scores, comparison)


def tuned_models(
    train: DataFrame,
    test: DataFrame,
    key: str,
    label: str = "is_default",
    names: Sequence[str] = tuple(learn.GRIDS),
    n_iter: int = 20,
    folds: int = 3,
    grids: Mapping[str, Mapping[str, Sequence[object]]] = learn.GRIDS,
) -> tuple[Trained, DataFrame, DataFrame]:
    """Search every slot, then evaluate each best model at its own best threshold.

    Returns the models, all trials, and the table of default against optimal thresholds.
    """
    train_rows, test_rows = prepare(train, test, key, label)
    models, trials = {}, None
    for name in names:
        models[name], _, tried = learn.search(train_rows, name, n_iter, folds, key, label, grids[name])
        trials = tried if trials is None else trials.unionByName(tried)
    scores = learn.score_all(test_rows, models).select(key, label, *models).checkpoint()
    long = learn.long_scores(scores, list(models), key, label)
    comparison = learn.evaluate_and_compare(scores, list(models), key, label)
    trained = Trained(models, None, scores, comparison)
    return trained, trials, evaluation.default_and_optimal(long)


def save_run(
    trained: Trained,
    data: DataFrame,
    folder: str,
    label: str = "is_default",
    trials: DataFrame | None = None,
    thresholds: DataFrame | None = None,
    n_iter: int = 0,
    cv_folds: int = 0,
) -> None:
    """Comparison as CSV, models in Spark's format, and the manifest; ``data`` has a ``split`` column.

    A tuned run also leaves its trials and the table of default against optimal thresholds, and its
    manifest names the best parameters as text, the number of trials and the folds.
    """
    tables.write_metrics(trained.comparison, f"{folder}/model_comparison")
    learn.save_models(trained.models, f"{folder}/models")
    if trained.forest is not None:
        trained.forest.save(f"{folder}/models/isolation_forest")
    extras, settings = {}, {}
    if trials is not None:
        trials.write.mode("errorifexists").parquet(f"{folder}/trials")
        extras["best_params"] = {r["model"]: r["params"] for r in learn.best_trials(trials).collect()}  # a row per model
        settings = {"n_iter": n_iter, "cv_folds": cv_folds}
    if thresholds is not None:
        tables.write_metrics(thresholds, f"{folder}/thresholds")
    manifest = tables.manifest(data, label, matrix.NUMERIC, CATEGORICAL_FEATURES, extras, settings)
    tables.write_manifest(manifest, f"{folder}/feature_info")


def prediction_table(trained: Trained, key: str, label: str = "is_default") -> DataFrame:
    """True label and a ``<model>_proba`` column per model, with their plain mean as ensemble."""
    names = [c for c in trained.test_scores.columns if c not in (key, label)]
    mean = sum((F.col(n) for n in names), F.lit(0.0)) / F.lit(float(len(names)))
    return trained.test_scores.select(
        F.col(label).alias("y_true"),
        *[F.col(n).alias(f"{n}_proba") for n in names],
        mean.alias("ensemble_proba"),
    )


def test_scores_long(trained: Trained, key: str, label: str = "is_default") -> DataFrame:
    names = [c for c in trained.test_scores.columns if c not in (key, label)]
    renamed = trained.test_scores.withColumnsRenamed({key: "id", label: "label"})
    return to_long(renamed, names, ["id", "label"])
