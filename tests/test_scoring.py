"""Ensemble arithmetic, alert fields and features on known rows."""

import math

import pytest
from pyspark.sql import functions as F

from riskloom.functions import features, scoring
from riskloom.operators import ensemble, matrix, metrics
from riskloom.params import FIVE_MODEL_WEIGHTS, RiskBounds, ScoringParams, code_defaults

FIVE = {"catboost": 0.8, "xgboost": 0.8, "lightgbm": 0.7, "random_forest": 0.6, "isolation_forest": 0.5}
# One published alert: its four model scores, the resulting score and level.
GOLDEN = {
    "random_forest": 0.3273068070411682,
    "xgboost": 0.24366873502731323,
    "catboost": 0.5060434341430664,
    "lightgbm": 0.3956478238105774,
}
GOLDEN_SCORE = 0.3713572095422183
NAN = float("nan")


def on_map(spark, scores, build):
    df = spark.createDataFrame([(scores,)], "s map<string,double>")
    return df.select(build(F.col("s"))).first()[0]


def on_wide(spark, scores, build):
    df = spark.createDataFrame([tuple(scores.values())], ", ".join(f"{m} double" for m in scores))
    return df.select(build({m: F.col(m) for m in scores})).first()[0]


def test_weighted_mean_both_layouts(spark):
    assert on_map(spark, FIVE, lambda s: scoring.map_weighted_mean(s, FIVE_MODEL_WEIGHTS)) == pytest.approx(0.705)
    assert on_wide(spark, FIVE, lambda s: scoring.weighted_mean(s, FIVE_MODEL_WEIGHTS)) == pytest.approx(0.705)


def test_golden_alert(spark):
    score = on_map(spark, GOLDEN, lambda s: scoring.map_weighted_mean(s, FIVE_MODEL_WEIGHTS))
    assert score == pytest.approx(GOLDEN_SCORE, abs=1e-15)
    assert on_map(spark, GOLDEN, lambda s: scoring.map_triggered(s, 0.7)) == []
    assert on_map(spark, GOLDEN, lambda s: scoring.risk_level(F.lit(GOLDEN_SCORE))) == "low"


def test_weights_may_be_scaled(spark):
    scaled = {m: 7 * w for m, w in FIVE_MODEL_WEIGHTS.items()}
    assert on_wide(spark, FIVE, lambda s: scoring.weighted_mean(s, scaled)) == pytest.approx(0.705)


def test_present_weights_only_and_default_weight(spark):
    two = {"xgboost": 0.8, "other": 0.2}
    expected = (0.8 * 0.3 + 0.2 * 0.1) / 0.4
    assert on_map(spark, two, lambda s: scoring.map_weighted_mean(s, {"xgboost": 0.3})) == pytest.approx(expected)
    gone = {"xgboost": 0.8, "catboost": None}
    assert on_wide(spark, gone, lambda s: scoring.weighted_mean(s, {"xgboost": 0.3, "catboost": 0.7})) == pytest.approx(0.8)


def test_empty_scores(spark):
    empty = {}
    assert on_map(spark, empty, lambda s: scoring.map_weighted_mean(s, FIVE_MODEL_WEIGHTS)) == 0.5
    assert on_map(spark, empty, scoring.median_score) == 0.5
    assert on_map(spark, empty, lambda s: scoring.voting_score(s, 0.5)) == 0.0
    assert on_map(spark, empty, scoring.max_score) == 0.0
    assert on_map(spark, empty, scoring.min_score) == 1.0
    assert on_map(spark, empty, scoring.agreement) is None


def test_equal_vote_median(spark):
    assert on_wide(spark, {"a": 0.8, "b": 0.6}, scoring.equal_mean) == pytest.approx(0.7)
    four = {"a": 0.8, "b": 0.6, "c": 0.4, "d": 0.3}
    assert on_map(spark, four, lambda s: scoring.voting_score(s, 0.5)) == 0.5
    assert on_map(spark, four, scoring.median_score) == pytest.approx(0.5)
    five = {"a": 0.9, "b": 0.7, "c": 0.5, "d": 0.3, "e": 0.1}
    assert on_map(spark, five, scoring.median_score) == 0.5
    assert on_map(spark, {"a": 0.2}, scoring.median_score) == 0.2


def test_nan_is_skipped_by_extremes_and_never_alerts(spark):
    scores = {"a": NAN, "b": 0.4}
    assert on_map(spark, scores, scoring.max_score) == 0.4
    assert on_map(spark, scores, scoring.min_score) == 0.4
    assert on_map(spark, scores, scoring.median_score) == 0.4
    row = spark.createDataFrame([(NAN,)], "s double").select(
        scoring.at_least(F.col("s"), 0.5), scoring.risk_level(F.col("s")), scoring.score_bucket(F.col("s")),
        scoring.clamp01(F.col("s")),
    ).first()
    assert row[0] is False and row[1] == "low" and row[2] == 9 and math.isnan(row[3])


def test_clamp(spark):
    values = [(-0.5,), (0.0,), (0.3,), (1.0,), (1.7,)]
    rows = spark.createDataFrame(values, "s double").select(scoring.clamp01(F.col("s"))).collect()
    assert [r[0] for r in rows] == [0.0, 0.0, 0.3, 1.0, 1.0]


def test_levels_at_and_around_bounds(spark):
    cases = {0.1: "low", 0.499: "low", 0.5: "medium", 0.7: "high", 0.75: "high", 0.9: "critical", 0.95: "critical"}
    rows = spark.createDataFrame([(s,) for s in cases], "s double").select("s", scoring.risk_level(F.col("s"), RiskBounds()))
    assert {r[0]: r[1] for r in rows.collect()} == cases


def test_agreement(spark):
    close = {"a": 0.8, "b": 0.82, "c": 0.79}
    by_map = on_map(spark, close, scoring.agreement)
    assert by_map > 0.9
    assert on_wide(spark, close, scoring.wide_agreement) == pytest.approx(by_map)


def test_gate_halves(spark):
    mean = F.lit(0.4)
    assert on_map(spark, {"a": 0.3}, lambda s: scoring.gated(mean, s, 0.5)) == 0.2
    assert on_map(spark, {"a": 0.5}, lambda s: scoring.gated(mean, s, 0.5)) == 0.4


def test_triggered_is_strict_and_sorted(spark):
    scores = {"xgboost": 0.9, "catboost": 0.56, "lightgbm": 0.571}
    assert on_wide(spark, scores, lambda s: scoring.triggered(s, 0.56)) == ["lightgbm:0.57", "xgboost:0.90"]


def test_strategies(spark):
    scores = {"xgboost": 0.9, "catboost": 0.5}
    primary = ScoringParams(strategy="primary")
    row = on_wide(spark, scores, lambda s: scoring.predict(s, primary))
    assert row["risk_score"] == 0.9 and row["model_scores"] == {"xgboost": 0.9}
    assert row["triggered_features"] == ["xgboost:0.90"]
    failed = on_wide(spark, {"xgboost": None, "catboost": 0.8}, lambda s: scoring.predict(s, primary))
    assert failed["model_scores"] == {"catboost": 0.8, "xgboost": 0.5}
    absent = on_wide(spark, {"catboost": 0.8}, lambda s: scoring.predict(s, primary))
    assert absent["risk_score"] == pytest.approx(0.8)
    assert absent["model_scores"] == {} and absent["triggered_features"] == []


def test_thresholds_by_strategy():
    assert ScoringParams(strategy="primary").strategy_threshold() == 0.61
    assert ScoringParams().strategy_threshold() == 0.56
    assert ScoringParams(strategy="primary", thresholds={}).strategy_threshold() == 0.61
    assert ScoringParams(thresholds={}).strategy_threshold() == 0.56
    assert code_defaults().strategy == "primary" and len(code_defaults().weights) == 5
    with pytest.raises(ValueError):
        ScoringParams(strategy="other")


@pytest.mark.parametrize(
    "classes, expected", [({0: 0.3, 1: 0.7}, 0.7), ({0: 0.3}, 0.7), ({}, 0.5), ({1: 0.2}, 0.2)]
)
def test_probability_from_map(spark, classes, expected):
    df = spark.createDataFrame([(classes,)], "m map<int,double>")
    assert df.select(scoring.probability_from_map(F.col("m"))).first()[0] == pytest.approx(expected)


@pytest.mark.parametrize("values, expected", [([0.3, 0.7], 0.7), ([0.4], 0.4), ([], 0.5), ([0.1, 0.2, 0.7], 0.2)])
def test_probability_from_array(spark, values, expected):
    df = spark.createDataFrame([(values,)], "a array<double>")
    assert df.select(scoring.probability_from_array(F.col("a"))).first()[0] == expected


def test_long_and_wide_ensembles_agree(spark):
    rows = [(1, "xgboost", 0.9), (1, "catboost", None), (2, "xgboost", None), (2, "new", 0.3)]
    scores = spark.createDataFrame(rows, "id int, model string, score double")
    weights = ensemble.parameter_table(spark, {"xgboost": 0.3}, "weight")
    found = {r["id"]: r["ensemble"] for r in ensemble.weighted_mean(scores, weights).collect()}
    assert found == {1: pytest.approx(0.9), 2: pytest.approx(0.3)}
    maps = {r["id"]: r["model_scores"] for r in ensemble.to_map(scores, ["xgboost", "catboost", "new"]).collect()}
    assert maps == {1: {"xgboost": 0.9}, 2: {"new": 0.3}}


def base_row(**changes):
    row = {"limit_bal": 50000.0, "sex": 1, "education": 1, "marriage": 1, "age": 35}
    row |= {n: 0 for n in features.PAY_COLUMNS}
    row |= {n: 0.0 for n in (*features.BILL_COLUMNS, *features.PAID_COLUMNS)}
    return row | changes


def schema():
    ints = {"sex", "education", "marriage", "age", *features.PAY_COLUMNS}
    return ", ".join(f"{n} {'int' if n in ints else 'double'}" for n in base_row())


def test_feature_vector(spark):
    df = spark.createDataFrame([tuple(base_row().values())], schema())
    built = matrix.feature_matrix(features.add_serving_features(df))
    assert len(built.columns) == 36 and built.first()[0] == 50000.0 and built.first()[1] == 35.0
    assert len(matrix.assemble(built).first()["features"]) == 36


@pytest.mark.parametrize(
    "policy, expected",
    [
        ("serving", [4, 0, 0, 1, 3, 4, 4, 4]),
        ("training", [0, 0, 0, 1, 3, 4, 4, 0]),
        ("scripts", [2, 2, 0, 1, 3, 4, 4, 2]),
        ("r", [0, 0, 0, 1, 3, 4, 4, 4]),
    ],
)
def test_age_edges(spark, policy, expected):
    ages = spark.createDataFrame([(a,) for a in (-1, 0, 25, 26, 55, 56, 100, 101)], "age int")
    assert [r[0] for r in ages.select(features.age_group(policy)).collect()] == expected


def test_feature_edges(spark):
    rows = [
        base_row(limit_bal=0.0, bill_amt1=-500.0, pay_amt1=100.0),
        base_row(pay_0=None, pay_2=3, bill_amt1=None, bill_amt2=60.0),
    ]
    built = features.add_features(spark.createDataFrame([tuple(r.values()) for r in rows], schema())).collect()
    assert built[0]["utilization_ratio"] == -500.0 and built[0]["pay_bill_ratio"] == pytest.approx(100 / 501)
    assert built[0]["over_limit"] == 0
    assert built[1]["avg_pay_delay"] == pytest.approx(3 / 5) and built[1]["months_delayed"] == 1
    assert built[1]["avg_bill_amt"] == 12.0 and built[1]["over_limit"] == 0
    assert built[1]["bill_volatility"] == pytest.approx(math.sqrt((48**2 + 4 * 12**2) / 4))


def test_features_need_their_columns(spark):
    only_age = spark.createDataFrame([(30,)], "AGE int")
    assert features.add_features(only_age).columns == ["AGE", "age_group"]


def test_scaler_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = matrix.apply_scaler(df, matrix.fit_scaler(df, ["a", "b"])).orderBy("a").collect()
    assert [r["a"] for r in rows] == pytest.approx([-math.sqrt(1.5), 0, math.sqrt(1.5)])
    assert [r["b"] for r in rows] == [0.0, 0.0, 0.0]


def test_histogram_keeps_every_row(spark):
    scores = spark.createDataFrame([(s,) for s in (0.0, 0.05, 0.1, 0.95, 1.0, 2.0, NAN)], "risk_score double")
    found = {r["bucket"]: r["n"] for r in metrics.score_histogram(scores).collect()}
    assert len(found) == 10 and sum(found.values()) == 7
    assert found[0] == 2 and found[1] == 1 and found[9] == 4
