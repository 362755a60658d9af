"""Evaluation of probabilities against labels.

Input is long: ``model, score, label`` (0/1). Everything that needs an order starts from
:func:`score_table`, one row per distinct score of a model, so the shuffle carries distinct scores
and ties are settled for good. A null score counts as the neutral 0.5, as it does when scoring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.scoring import at_least
from riskloom.operators.clean import binarise
from riskloom.operators.running import SLICES_PER_OCTAVE, running_totals, slice_by_value
from riskloom.params import NEUTRAL_SCORE

METRICS = ("f1", "precision", "recall")
EPSILON = 1e-8
# The threshold grid 0.10 .. 0.90 in steps of 0.01, in hundredths.
GRID_FIRST, GRID_LAST = 10, 90
GRID_DEFAULT = 0.5


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 on an empty denominator."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1_score(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(tp * 2, tp * 2 + fp + fn)


def accuracy(tp: Column, fp: Column, tn: Column, fn: Column) -> Column:
    return ratio(tp + tn, tp + fp + tn + fn)


def false_alarm_rate(counts: tuple[Column, Column, Column, Column], definition: str = "fpr") -> Column:
    """Three definitions: FP/(FP+TN); one minus precision; one minus specificity."""
    tp, fp, tn, _ = counts
    if definition == "fpr":
        return ratio(fp, fp + tn)
    if definition == "one_minus_precision":
        return F.lit(1.0) - precision(tp, fp)
    if definition == "one_minus_specificity":
        return F.lit(1.0) - ratio(tn, tn + fp)
    raise ValueError(f"unknown false alarm definition: {definition}")


def neutral(scores: DataFrame) -> DataFrame:
    return scores.withColumn("score", F.coalesce("score", F.lit(NEUTRAL_SCORE)))


# --- counts at a threshold ----------------------------------------------------------------------


def confusion_aggregates(predicted: Column, label: str = "label") -> list[Column]:
    hit, real = predicted == 1, F.col(label) == 1
    return [
        F.count_if(hit & real).alias("tp"),
        F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & ~real).alias("tn"),
        F.count_if(~hit & real).alias("fn"),
    ]


def confusion(scores: DataFrame, threshold: Column | float = 0.5) -> DataFrame:
    """tp, fp, tn, fn per model; one partially aggregated pass."""
    predicted = binarise(F.col("score"), threshold)
    return neutral(scores).groupBy("model").agg(*confusion_aggregates(predicted))


def counts() -> tuple[Column, Column, Column, Column]:
    """The confusion counts of a table that has them as columns."""
    return F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn")


def count_metrics() -> list[Column]:
    tp, fp, tn, fn = counts()
    return [
        accuracy(tp, fp, tn, fn).alias("accuracy"),
        precision(tp, fp).alias("precision"),
        recall(tp, fn).alias("recall"),
        f1_score(tp, fp, fn).alias("f1"),
    ]


def at_threshold(scores: DataFrame, threshold: float) -> DataFrame:
    """Accuracy, precision, recall and F1 of each model at one threshold."""
    return confusion(scores, threshold).select(
        "model", F.lit(threshold).alias("threshold"), *count_metrics()
    )


def classification_report(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows per class plus accuracy, macro and weighted averages, per model."""
    tp, fp, tn, fn = counts()
    n = tp + fp + tn + fn
    negative = (precision(tn, fn), recall(tn, fp), f1_score(tn, fn, fp), tn + fp)
    positive = (precision(tp, fp), recall(tp, fn), f1_score(tp, fp, fn), tp + fn)
    exact = accuracy(tp, fp, tn, fn)
    macro = [(a + b) / 2.0 for a, b in zip(negative[:3], positive[:3], strict=True)]
    weighted = [
        ratio(a * negative[3] + b * positive[3], n)
        for a, b in zip(negative[:3], positive[:3], strict=True)
    ]

    def row(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            support.alias("support"),
        )

    rows = F.array(
        row("0", *negative),
        row("1", *positive),
        row("accuracy", exact, exact, exact, n),
        row("macro avg", *macro, n),
        row("weighted avg", *weighted, n),
    )
    return confusion(scores, threshold).select("model", F.inline(rows))


def business_metrics(scores: DataFrame, threshold: float = 0.5, amount: str = "amount") -> DataFrame:
    """Amounts at stake: total, detected, missed and falsely alarmed, with rates and averages."""
    hit = binarise(F.col("score"), threshold) == 1
    real = F.col("label") == 1
    money = F.col(amount)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, money)), F.lit(0.0))

    sums = neutral(scores).groupBy("model").agg(
        total(real).alias("total_fraud_amount"),
        total(real & hit).alias("detected_fraud_amount"),
        total(real & ~hit).alias("missed_fraud_amount"),
        total(~real & hit).alias("false_alarm_amount"),
        F.count_if(real & hit).alias("_detected"),
        F.count_if(real & ~hit).alias("_missed"),
    )
    detected, missed = F.col("detected_fraud_amount"), F.col("missed_fraud_amount")
    return sums.select(
        "model",
        "total_fraud_amount",
        detected,
        missed,
        "false_alarm_amount",
        ratio(detected, F.col("total_fraud_amount")).alias("fraud_amount_detection_rate"),
        ratio(detected, F.col("_detected")).alias("avg_detected_fraud_amount"),
        ratio(missed, F.col("_missed")).alias("avg_missed_fraud_amount"),
    )


# --- curves -------------------------------------------------------------------------------------


def score_table(scores: DataFrame) -> DataFrame:
    """Positives and negatives per model and distinct score."""
    return (
        neutral(scores)
        .groupBy("model", "score")
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") != 1).alias("neg"),
        )
    )


def cumulative(scores: DataFrame, slices: int = SLICES_PER_OCTAVE) -> DataFrame:
    """Per distinct score: counts at it, counts at or above it, and the model's totals."""
    sliced = slice_by_value(score_table(scores), "score", descending=True, slices=slices)
    values = {"pos": F.col("pos"), "neg": F.col("neg")}
    return running_totals(sliced, ["model"], [F.desc("score")], values).select(
        "model",
        "score",
        "pos",
        "neg",
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        F.col("all_pos").alias("positives"),
        F.col("all_neg").alias("negatives"),
    )


def _above() -> tuple[Column, Column]:
    """Positives and negatives at or above a row's score."""
    return F.col("tp"), F.col("fp")


def _totals() -> tuple[Column, Column]:
    return F.col("positives"), F.col("negatives")


def auc_aggregate() -> Column:
    """Pairs ordered rightly plus half the tied ones, over all pairs; null for a single class."""
    (_, fp), (positives, negatives) = _above(), _totals()
    won = F.col("pos") * ((negatives - fp).cast("double") + F.col("neg") * 0.5)
    return F.try_divide(F.sum(won), F.max(positives).cast("double") * F.max(negatives))


def average_precision_aggregate() -> Column:
    """Precision at each distinct score weighted by the recall it adds; null without positives."""
    return F.try_divide(F.sum(F.col("pos") * precision(*_above())), F.max("positives").cast("double"))


def roc_auc(scores: DataFrame) -> DataFrame:
    return cumulative(scores).groupBy("model").agg(auc_aggregate().alias("roc_auc"))


def average_precision(scores: DataFrame) -> DataFrame:
    return cumulative(scores).groupBy("model").agg(average_precision_aggregate().alias("pr_auc"))


def precision_recall_curve(scores: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score."""
    tp, fp = _above()
    return cumulative(scores).select(
        "model",
        F.col("score").alias("threshold"),
        precision(tp, fp).alias("precision"),
        ratio(tp, F.col("positives")).alias("recall"),
    )


def roc_curve(scores: DataFrame) -> DataFrame:
    """False and true positive rate at every distinct score."""
    tp, fp = _above()
    return cumulative(scores).select(
        "model",
        F.col("score").alias("threshold"),
        ratio(fp, F.col("negatives")).alias("fpr"),
        ratio(tp, F.col("positives")).alias("tpr"),
    )


def _at(score: float) -> list[Column]:
    """Confusion counts at a fixed threshold, from the cumulative table."""
    hit = at_least(F.col("score"), score)
    tp, fp = F.sum(F.when(hit, F.col("pos")).otherwise(0)), F.sum(F.when(hit, F.col("neg")).otherwise(0))
    return [
        tp.alias("tp"),
        fp.alias("fp"),
        (F.max("negatives") - fp).alias("tn"),
        (F.max("positives") - tp).alias("fn"),
    ]


def evaluate(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The full evaluation row of every model, in one pass over its distinct scores."""
    summed = (
        cumulative(scores)
        .groupBy("model")
        .agg(*_at(threshold), auc_aggregate().alias("roc_auc"), average_precision_aggregate().alias("pr_auc"))
    )
    tp, fp, tn, fn = counts()
    return summed.select(
        "model",
        *count_metrics(),
        "roc_auc",
        "pr_auc",
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        tn.alias("true_negatives"),
        fn.alias("false_negatives"),
        recall(tp, fn).alias("fraud_detection_rate"),
        false_alarm_rate(counts()).alias("false_alarm_rate"),
    )


# --- thresholds ---------------------------------------------------------------------------------


def _curve_metric(metric: str) -> Column:
    tp, fp = _above()
    p, r = precision(tp, fp), ratio(tp, F.col("positives"))
    if metric == "f1":
        return p * r * 2.0 / (p + r + F.lit(EPSILON))
    if metric == "precision":
        return p
    if metric == "recall":
        return r
    raise ValueError(f"unknown metric: {metric}")


def best_threshold(scores: DataFrame, metric: str = "f1") -> DataFrame:
    """Distinct score that maximises the metric, the lowest one on ties, and the value there."""
    value = _curve_metric(metric)
    best = F.max(F.struct(value.alias("value"), (-F.col("score")).alias("negated")))
    return (
        cumulative(scores)
        .groupBy("model")
        .agg(best.alias("best"))
        .select(
            "model",
            (-F.col("best.negated")).alias("optimal_threshold"),
            F.col("best.value").alias("best_score"),
        )
    )


def _grid_cell(score: Column) -> Column:
    """Highest grid step (in hundredths) a score reaches, judged by comparing, never by rounding."""
    near = F.floor(F.nanvl(score, F.lit(-1.0)) * 100.0)
    up = (score >= (near + 1).cast("double") / 100.0) & ~F.isnan(score)
    down = score < near.cast("double") / 100.0
    cell = near + F.when(up, 1).when(down, -1).otherwise(0)
    return F.least(F.greatest(cell, F.lit(GRID_FIRST - 1)), F.lit(GRID_LAST)).cast("int")


def grid_curve(scores: DataFrame) -> DataFrame:
    """F1 at each grid threshold. Rows are counted into grid cells before anything is sorted."""
    cells = (
        neutral(scores)
        .groupBy("model", _grid_cell(F.col("score")).alias("cell"))
        .agg(
            F.count_if(F.col("label") == 1).alias("pos"),
            F.count_if(F.col("label") != 1).alias("neg"),
        )
    )
    # At most 82 cells per model from here on.
    steps = (
        cells.select("model")
        .distinct()
        .select("model", F.explode(F.sequence(F.lit(GRID_FIRST - 1), F.lit(GRID_LAST))).alias("cell"))
    )
    above = W.partitionBy("model").orderBy(F.desc("cell")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy("model")
    filled = steps.join(cells, ["model", "cell"], "left").fillna(0, ["pos", "neg"])
    tp, fp = F.sum("pos").over(above), F.sum("neg").over(above)
    return (
        filled.select("model", "cell", tp.alias("tp"), fp.alias("fp"), F.sum("pos").over(whole).alias("p"))
        .filter(F.col("cell") >= GRID_FIRST)
        .select(
            "model",
            (F.col("cell").cast("double") / 100.0).alias("threshold"),
            f1_score(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp")).alias("f1"),
        )
    )


def best_grid_threshold(scores: DataFrame) -> DataFrame:
    """Grid threshold of strictly best F1, the first on ties, 0.5 when none beats 0."""
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("negated")))
    found = grid_curve(scores).groupBy("model").agg(best.alias("best"))
    beaten = F.col("best.f1") > 0
    return found.select(
        "model",
        F.when(beaten, -F.col("best.negated")).otherwise(GRID_DEFAULT).alias("optimal_threshold"),
        F.col("best.f1").alias("best_score"),
    )


def default_and_optimal(scores: DataFrame, default: float = 0.5) -> DataFrame:
    """Each model's metrics at the default and at its own best threshold, side by side."""
    table = cumulative(scores)
    value = _curve_metric("f1")
    (tp, fp), (positives, negatives) = _above(), _totals()
    best = F.max(
        F.struct(
            value.alias("value"),
            (-F.col("score")).alias("negated"),
            tp,
            fp,
            (negatives - fp).alias("tn"),
            (positives - tp).alias("fn"),
        )
    )
    summed = table.groupBy("model").agg(best.alias("best"), *_at(default))
    tuned = tuple(F.col(f"best.{c}") for c in ("tp", "fp", "tn", "fn"))

    def block(counts: tuple[Column, ...], suffix: str) -> list[Column]:
        tp, fp, tn, fn = counts
        return [
            accuracy(tp, fp, tn, fn).alias(f"accuracy_{suffix}"),
            precision(tp, fp).alias(f"precision_{suffix}"),
            recall(tp, fn).alias(f"recall_{suffix}"),
            f1_score(tp, fp, fn).alias(f"f1_{suffix}"),
        ]

    return summed.select(
        "model",
        (-F.col("best.negated")).alias("optimal_threshold"),
        *block(counts(), "default"),
        *block(tuned, "optimal"),
    )


def positive_as(scores: DataFrame, positive_label: int) -> DataFrame:
    """Take ``positive_label`` as the positive class; scores keep their meaning."""
    return scores.withColumn("label", (F.col("label") == positive_label).cast("int"))


# --- data set descriptions ----------------------------------------------------------------------


def class_distribution(df: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split, label).agg(F.count("*").alias("n"))


def dataset_stats(df: DataFrame, features: int, split: str = "split", label: str = "label") -> DataFrame:
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"),
        F.lit(features).alias("n_features"),
        F.avg(label).alias("default_rate"),
    )
