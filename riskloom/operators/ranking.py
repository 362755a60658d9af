"""Ranking and comparing models, and top-k reports of alerts.

Model tables have a row per model, so their windows are tiny; alert reports go through joins and
``orderBy().limit()``, which keeps k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.evaluation import confusion_aggregates, count_metrics, ratio

# Metrics compared head to head, and the ones averaged into an overall rank.
COMPARED = ("roc_auc", "f1", "precision", "recall", "accuracy")
RANKED = ("roc_auc", "f1", "precision", "recall")
ENSEMBLE = "ensemble"


def compare_models(results: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """Append ``rank`` 1..n by a metric, highest first."""
    best_first = W.partitionBy().orderBy(F.desc(metric), F.asc("model"))
    return results.withColumn("rank", F.row_number().over(best_first))


def _mean_rank(metric: str) -> Column:
    """Rank from the top where tied models share the mean of their ranks.

    Ranks from either end differ by the ties, so no window per value is needed and all metrics are
    ranked in one stage over the table, which has a row per model.
    """
    down, up = W.partitionBy().orderBy(F.desc(metric)), W.partitionBy().orderBy(F.asc(metric))
    return (F.rank().over(down) + F.count("*").over(W.partitionBy()) + 1 - F.rank().over(up)) / F.lit(2.0)


def overall_ranking(results: DataFrame, metrics: Sequence[str] = RANKED) -> DataFrame:
    """Mean of the ranks over several metrics and the rank by that mean, ensemble left out."""
    ranks = results.filter(F.col("model") != ENSEMBLE).select(
        "model", *[_mean_rank(m).alias(f"rank_{m}") for m in metrics]
    )
    total = sum((F.col(f"rank_{m}") for m in metrics), F.lit(0.0))
    averaged = ranks.withColumn("avg_rank", total / F.lit(float(len(metrics))))
    return averaged.withColumn(
        "overall_rank", F.row_number().over(W.partitionBy().orderBy("avg_rank", "model"))
    )


def best_single(results: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The best model by a metric, ensemble excluded, the first by name on ties."""
    singles = results.filter(F.col("model") != ENSEMBLE)
    return singles.orderBy(F.desc(metric), F.asc("model")).limit(1)


def top_importances(importances: DataFrame, n: int = 20) -> DataFrame:
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def metrics_long(results: DataFrame, metrics: Sequence[str] = COMPARED) -> DataFrame:
    """One row per model and metric."""
    return results.select("model", *metrics).unpivot("model", list(metrics), "metric", "value")


def head_to_head(
    results: DataFrame,
    first: str,
    second: str,
    tie_band: float = 0.0,
    metrics: Sequence[str] = COMPARED,
) -> DataFrame:
    """Two models metric by metric: both values, their difference and who wins."""
    sides = (
        metrics_long(results.filter(F.col("model").isin(first, second)), metrics)
        .groupBy("metric")
        .pivot("model", [first, second])
        .agg(F.max("value"))
    )
    gap = F.col(first) - F.col(second)
    winner = F.when(gap > tie_band, first).when(gap < -tie_band, second).otherwise("tie")
    return sides.withColumns({"difference": gap, "winner": winner})


def win_tally(comparison: DataFrame, first: str, second: str) -> DataFrame:
    """Wins of each side, ties, and who wins overall."""
    counted = comparison.agg(
        F.count_if(F.col("winner") == first).alias("first_wins"),
        F.count_if(F.col("winner") == second).alias("second_wins"),
        F.count_if(F.col("winner") == "tie").alias("ties"),
    )
    overall = (
        F.when(F.col("first_wins") > F.col("second_wins"), first)
        .when(F.col("second_wins") > F.col("first_wins"), second)
        .otherwise("tie")
    )
    return counted.withColumn("overall_winner", overall)


def ensemble_improvement(results: DataFrame) -> DataFrame:
    """Change in percent of AUC and F1 from the best single model to the ensemble."""

    def of_ensemble(metric: str) -> Column:
        return F.max(F.when(F.col("model") == ENSEMBLE, F.col(metric)))

    single = best_single(results).select(F.struct("model", "roc_auc", "f1")).scalar()
    both = results.agg(of_ensemble("roc_auc").alias("e_auc"), of_ensemble("f1").alias("e_f1")).withColumn(
        "best", single
    )
    return both.select(
        F.col("best.model").alias("best_model"),
        (ratio(F.col("e_auc") - F.col("best.roc_auc"), F.col("best.roc_auc")) * 100.0).alias(
            "roc_improvement"
        ),
        (ratio(F.col("e_f1") - F.col("best.f1"), F.col("best.f1")) * 100.0).alias("f1_improvement"),
    )


def min_max_scaled(results: DataFrame, metrics: Sequence[str] = COMPARED) -> DataFrame:
    """Each metric stretched to [0, 1] across the models, ensemble left out; null if all are equal."""
    singles = results.filter(F.col("model") != ENSEMBLE)
    everyone = W.partitionBy()

    def stretched(m: str) -> Column:
        low, high = F.min(m).over(everyone), F.max(m).over(everyone)
        return F.try_divide(F.col(m) - low, high - low).alias(m)

    return singles.select("model", *[stretched(m) for m in metrics])


# --- alerts against labels ----------------------------------------------------------------------


def one_per_id(alerts: DataFrame, key: str = "transaction_id") -> DataFrame:
    """The last alert of each transaction, the higher score on equal times: sinks may repeat alerts."""
    last = F.max_by(F.struct(*alerts.columns), F.struct(*_timed(alerts), "risk_score"))
    return alerts.groupBy(F.col(key).alias("_id")).agg(last.alias("_last")).select("_last.*")


def _timed(alerts: DataFrame) -> list[str]:
    return ["timestamp"] if "timestamp" in alerts.columns else []


def id_order(key: str = "transaction_id") -> Column:
    """Ids in order: numbers by value before all others, those by text."""
    number = F.col(key).try_cast("long")
    return F.struct(number.isNull().alias("text"), number.alias("number"), F.col(key).alias("id"))


def with_alerts(labels: DataFrame, alerts: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Labels with the score of their alert, 0 without one, and whether there is one."""
    scored = one_per_id(alerts.select(key, *_timed(alerts), "risk_score"), key).select(key, F.col("risk_score").alias("predicted_score"), F.lit(True).alias("has_alert"))
    return labels.join(scored, key, "left").fillna(0.0, ["predicted_score"]).fillna(False, ["has_alert"])


def alerts_with_label(
    labels: DataFrame, alerts: DataFrame, label: int, key: str = "transaction_id"
) -> DataFrame:
    """Alerts whose transaction carries the label: 1 for right ones, 0 for false ones."""
    wanted = labels.filter(F.col("is_default") == label).select(key)
    return one_per_id(alerts, key).join(wanted, key, "left_semi")


def missed(labels: DataFrame, alerts: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Positive labels without an alert."""
    return labels.filter(F.col("is_default") == 1).join(alerts.select(key), key, "left_anti")


def top_alerts(alerts: DataFrame, n: int) -> DataFrame:
    """Highest scores first, the smaller id first on ties."""
    return alerts.orderBy(F.desc("risk_score"), id_order()).limit(n)


def alert_quality(labels: DataFrame, alerts: DataFrame) -> DataFrame:
    """Confusion counts and metrics where an alert is the prediction."""
    joined = with_alerts(labels, alerts).select(
        F.col("has_alert").cast("int").alias("hit"),
        F.col("is_default").alias("label"),
    )
    return joined.agg(*confusion_aggregates(F.col("hit"))).select("tp", "fp", "tn", "fn", *count_metrics())
