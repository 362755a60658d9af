"""Sliced operators against plain windows and brute force, skew included."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators import evaluation, metrics, ranking, splits, velocity


@pytest.fixture(scope="module")
def scores(spark):
    """Two models, one with two thirds of the rows, many ties, a third of them on one score."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        s = 0.5 if i % 3 == 0 else round(rng.random() ** 3, 3)
        rows.append(("big", s, int(rng.random() < 0.2 + 0.5 * s)))
    rows += [("small", rng.random(), int(rng.random() < 0.3)) for _ in range(300)]
    return spark.createDataFrame(rows, "model string, score double, label int").cache()


def brute(scores, model):
    rows = [(r["score"], r["label"]) for r in scores.collect() if r["model"] == model]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        ap += (tp - seen) / len(pos) * tp / (tp + fp)
        seen = tp
    best = max(
        (2 * p * r / (p + r + 1e-8), -t)
        for t in {s for s, _ in rows}
        for p, r in [(sum(s >= t for s in pos) / sum(s >= t for s, _ in rows), sum(s >= t for s in pos) / len(pos))]
    )
    return auc, ap, best


def test_curves_against_brute_force(spark, scores):
    found = {r["model"]: r for r in evaluation.evaluate(scores).collect()}
    thresholds = {r["model"]: r for r in evaluation.best_threshold(scores).collect()}
    for model in ("big", "small"):
        auc, ap, (f1, negated) = brute(scores, model)
        assert found[model]["roc_auc"] == pytest.approx(auc)
        assert found[model]["pr_auc"] == pytest.approx(ap)
        assert thresholds[model]["optimal_threshold"] == -negated
        assert thresholds[model]["best_score"] == pytest.approx(f1)


def test_auc_equals_spark_evaluator(spark, scores):
    big = scores.filter("model = 'big'")
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert evaluation.roc_auc(big).first()["roc_auc"] == pytest.approx(judge.evaluate(big))


@pytest.mark.parametrize("slices", [1, 2, 7, 64])
def test_slicing_changes_nothing(spark, scores, slices):
    table = evaluation.score_table(scores)
    plain = W.partitionBy("model").orderBy(F.desc("score"))
    expected = table.select("model", "score", F.sum("pos").over(plain).alias("tp"), F.sum("neg").over(plain).alias("fp"))
    got = evaluation.cumulative(scores, slices).select("model", "score", "tp", "fp")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_auc_under_monotone_map(spark, scores):
    bent = scores.withColumn("score", F.pow("score", F.lit(0.5)))
    a, b = ({r["model"]: r["roc_auc"] for r in evaluation.roc_auc(s).collect()} for s in (scores, bent))
    assert a == pytest.approx(b)


def test_degenerate_labels(spark):
    rows = [("one_class", 0.2, 1), ("one_class", 0.7, 1), ("flat", 0.4, 0), ("flat", 0.4, 1), ("gaps", None, 1), ("gaps", 0.1, 0)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    found = {r["model"]: r for r in evaluation.evaluate(df).collect()}
    assert found["one_class"]["roc_auc"] is None and found["one_class"]["pr_auc"] == 1.0
    assert found["flat"]["roc_auc"] == 0.5 and found["flat"]["precision"] == 0.0
    assert found["gaps"]["true_positives"] == 1
    assert evaluation.evaluate(df.limit(0)).count() == 0


def test_unknown_names_are_errors(scores):
    with pytest.raises(ValueError):
        evaluation.best_threshold(scores, "lift")
    with pytest.raises(ValueError):
        evaluation.false_alarm_rate(evaluation.counts(), "other")
    with pytest.raises(ValueError):
        velocity.velocity_features(scores, ["unknown"])


def test_grid_threshold(spark, scores):
    rows = [(r["model"], r["score"], r["label"]) for r in scores.collect()]
    found = {r["model"]: r for r in evaluation.best_grid_threshold(scores).collect()}
    for model in ("big", "small"):
        best, at = 0.0, 0.5
        for k in range(10, 91):
            t = k / 100
            tp = sum(1 for m, s, y in rows if m == model and s >= t and y)
            wrong = sum(1 for m, s, y in rows if m == model and (s >= t) != bool(y))
            f1 = 2 * tp / (2 * tp + wrong) if tp else 0.0
            if f1 > best:
                best, at = f1, t
        assert (found[model]["optimal_threshold"], found[model]["best_score"]) == (at, pytest.approx(best))


def test_grid_edges_are_compared_not_rounded(spark):
    edges = [(k / 100,) for k in range(0, 101)] + [(np.nextafter(k / 100, 0),) for k in range(10, 91)]
    cells = spark.createDataFrame([(float(e[0]),) for e in edges], "s double").select("s", evaluation._grid_cell(F.col("s")).alias("c"))
    for s, c in cells.collect():
        assert c == max([k for k in range(10, 91) if s >= k / 100], default=9)


def test_latency_and_quantile(spark):
    rng = random.Random(5)
    values = [rng.choice([7, 7, 7, rng.randrange(1000)]) for _ in range(997)]
    df = spark.createDataFrame([(v,) for v in values], "duration_us long")
    ordered, n = sorted(values), len(values)
    row = metrics.latency_stats(df).first()
    assert row.asDict() == {
        "calls": n, "mean_us": sum(values) // n, "p50_us": ordered[n // 2], "p95_us": ordered[int(n * 0.95)],
        "p99_us": ordered[int(n * 0.99)], "max_us": ordered[-1],
    }
    assert metrics.exact_quantile(df, "duration_us", 0.137).first()[0] == pytest.approx(np.quantile(values, 0.137))
    empty = metrics.latency_stats(df.limit(0)).first().asDict()
    assert set(empty.values()) == {0}


@pytest.mark.parametrize("cap", [4, 10])
def test_retained_history(spark, cap):
    kept, held = [], []
    for i in range(60):
        held.append(i)
        if len(held) > cap:
            del held[: cap // 2]
        kept.append(len(held))
    sizes = spark.range(1, 61).select("id", metrics.retained(F.col("id"), cap).alias("r")).orderBy("id")
    assert [r["r"] for r in sizes.collect()] == kept


def test_anomaly_probability_constant(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "raw double")
    assert [r["anomaly_score"] for r in metrics.anomaly_probability(df, "raw").collect()] == [0.0, 0.0]


def brute_velocity(rows):
    out = {}
    for e, card, kind, t, v in rows:
        before = sorted((r for r in rows if r[1] == card and (r[3], r[0]) < (t, e)), key=lambda r: (r[3], r[0]))
        hour = [r for r in before if t - timedelta(hours=1) <= r[3] < t]
        day = [r for r in before if t - timedelta(hours=24) <= r[3] < t]
        first = min(r[3] for r in rows if r[1] == card)
        out[e] = (
            len(hour), round(sum(r[4] for r in hour), 2), len(day), round(sum(r[4] for r in day), 2),
            len({r[2] for r in day}), round(sum(r[4] for r in before) / len(before), 6) if before else None,
            sum(r[2] == "error" for r in hour),
            int((t - before[-1][3]).total_seconds()) if before else None, (t.date() - first.date()).days,
        )
    return out


@pytest.mark.parametrize("slice_points", [1, 40, 100_000])
def test_velocity_against_brute_force(spark, slice_points):
    """A card with most events, equal times, and gaps of exactly an hour and a day."""
    rng, start, rows = random.Random(11), datetime(2024, 1, 1), []
    for e in range(160):
        card = 1 if e % 4 else rng.randrange(2, 6)
        t = start + timedelta(minutes=30 * rng.randrange(0, 200))
        rows.append((e, card, rng.choice(["click", "error", "view"]), t, round(rng.uniform(0.01, 400), 2)))
    df = spark.createDataFrame(rows, "event_id long, user_id int, event_type string, ts timestamp_ntz, value double")
    got = velocity.velocity_features(df, slice_points=slice_points).collect()
    found = {
        r["event_id"]: tuple(
            round(x, 6 if f == "avg_tx_amount" else 2) if isinstance(x, float) else x
            for f, x in ((f, r[f]) for f in velocity.FEATURES)
        )
        for r in got
    }
    assert found == brute_velocity(rows)


def keyed(spark, n=503):
    return spark.range(n).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))


def test_stratified_split(spark):
    df = keyed(spark)
    parts = splits.stratified_split(df, "id", "y", 0.8)
    sizes = {(r["split"], r["y"]): r["count"] for r in parts.groupBy("split", "y").count().collect()}
    per_class = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    for y, n in per_class.items():
        assert sizes["train", y] == int(n * 0.8) and sizes["train", y] + sizes["test", y] == n
    assert parts.select("id").distinct().count() == df.count()
    again = splits.stratified_split(df.repartition(7), "id", "y", 0.8)
    assert parts.exceptAll(again).isEmpty()
    other = splits.stratified_split(df, "id", "y", 0.8, seed="s")
    assert not parts.exceptAll(other).isEmpty()


def test_simple_split_and_folds(spark):
    df = keyed(spark)
    held = splits.simple_validation_split(df, "id").filter("split = 'validation'").count()
    assert held == 50
    folds = splits.stratified_folds(df, "id", "y", 3).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in folds if r["y"] == y]
        assert len(counts) == 3 and max(counts) - min(counts) <= 1


def results(spark):
    rows = [
        ("a", 0.8, 0.5, 0.6, 0.4, 0.9), ("b", 0.8, 0.6, 0.5, 0.4, 0.9), ("c", 0.7, 0.4, 0.6, 0.8, 0.7),
        ("ensemble", 0.84, 0.66, 0.6, 0.5, 0.9),
    ]
    return spark.createDataFrame(rows, "model string, roc_auc double, f1 double, precision double, recall double, accuracy double")


def test_rankings(spark):
    table = results(spark)
    ranked = {r["model"]: r for r in ranking.overall_ranking(table).collect()}
    assert ranked["a"]["rank_roc_auc"] == 1.5 and ranked["a"]["rank_precision"] == 1.5
    assert ranked["c"]["rank_recall"] == 1.0 and "ensemble" not in ranked
    assert sorted(r["overall_rank"] for r in ranked.values()) == [1, 2, 3]
    assert ranking.best_single(table).first()["model"] == "a"
    gain = ranking.ensemble_improvement(table).first()
    assert gain["best_model"] == "a" and gain["roc_improvement"] == pytest.approx(5.0)
    assert gain["f1_improvement"] == pytest.approx(32.0)
    assert ranking.compare_models(table).filter("rank = 1").first()["model"] == "ensemble"


def test_head_to_head(spark):
    versus = ranking.head_to_head(results(spark), "a", "b")
    assert {r["metric"]: r["winner"] for r in versus.collect()} == {
        "roc_auc": "tie", "f1": "b", "precision": "a", "recall": "tie", "accuracy": "tie"
    }
    tally = ranking.win_tally(versus, "a", "b").first()
    assert tuple(tally) == (1, 1, 3, "tie")


def test_min_max_of_equal_values_is_null(spark):
    flat = results(spark).filter("model in ('a', 'b')")
    rows = ranking.min_max_scaled(flat).collect()
    assert {r["roc_auc"] for r in rows} == {None} and {r["f1"] for r in rows} == {0.0, 1.0}


def test_alert_joins(spark):
    labels = spark.createDataFrame([("1", 1), ("2", 1), ("3", 0), ("4", 0)], "transaction_id string, is_default int")
    alerts = spark.createDataFrame([("1", 0.9), ("3", 0.6)], "transaction_id string, risk_score double")
    joined = {r["transaction_id"]: (r["predicted_score"], r["has_alert"]) for r in ranking.with_alerts(labels, alerts).collect()}
    assert joined == {"1": (0.9, True), "2": (0.0, False), "3": (0.6, True), "4": (0.0, False)}
    row = ranking.alert_quality(labels, alerts).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"], row["f1"]) == (1, 1, 1, 1, 0.5)
    assert [r["transaction_id"] for r in ranking.missed(labels, alerts).collect()] == ["2"]


def test_repeated_and_named_alerts(spark):
    labels = spark.createDataFrame([("tx_1", 1), ("tx_2", 1), ("3", 0)], "transaction_id string, is_default int")
    rows = [("tx_1", 0.9), ("tx_1", 0.9), ("3", 0.9), ("10", 0.9)]
    alerts = spark.createDataFrame(rows, "transaction_id string, risk_score double")
    row = ranking.alert_quality(labels, alerts).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"], row["recall"]) == (1, 1, 0, 1, 0.5)
    top = ranking.top_alerts(alerts.dropDuplicates(), 3).collect()
    assert [r["transaction_id"] for r in top] == ["3", "10", "tx_1"]
