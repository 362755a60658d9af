"""Leaf penalties against a loop over rows."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators import learn, penalised
from riskloom.session import work_dir


@pytest.fixture(scope="module")
def data(spark):
    frame = spark.range(200).select(
        F.col("id"), (F.pmod(F.xxhash64("id"), F.lit(10)) + F.col("id") % 5 > 8).cast("int").alias("is_default"),
        (F.col("id") % 5).cast("double").alias("a"), F.rand(3).alias("b"), (F.lit(1.0) + F.col("id") % 3).alias("weight"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(frame).persist()


@pytest.fixture(scope="module")
def model(data):
    return learn.classifier(learn.Slot("boosted", "positive"), maxIter=5, maxDepth=3, stepSize=0.3).fit(data)


def by_hand(rows, rates, penalty):
    """Leaf values from (y, w, leaves) rows, tree after tree."""
    odds, values = [0.0] * len(rows), []
    for tree, rate in enumerate(rates):
        sums = {}
        for (y, w, leaves), m in zip(rows, odds):
            p = 1 / (1 + math.exp(-m))
            slope, curve = sums.get(leaves[tree], (0.0, 0.0))
            sums[leaves[tree]] = slope + w * (y - p), curve + w * p * (1 - p)
        steps = {leaf: s / (c + penalty) for leaf, (s, c) in sums.items()}
        values.append(steps)
        odds = [m + rate * steps[leaves[tree]] for m, (_, _, leaves) in zip(odds, rows)]
    return values, odds


@pytest.mark.parametrize("penalty", [0.0, 5.0])
def test_values_and_scores_equal_a_loop(data, model, monkeypatch, penalty):
    monkeypatch.setattr(penalised, "CARRIED", 2)
    rows = [(r["is_default"], r["weight"], r["_leaves"]) for r in penalised._with_leaves(model, data).orderBy("id").collect()]
    expected, odds = by_hand(rows, model.treeWeights, penalty)
    found = penalised.refit_leaves(model, data, penalty)
    assert found.rates[0] == 1.0 and len(found.values) == 5
    for values, steps in zip(found.values, expected):
        assert {leaf: pytest.approx(v) for leaf, v in steps.items()} == {leaf: values[leaf] for leaf in steps}
    scored = found.transform(data).orderBy("id").select(vector_to_array("probability")[1].alias("p")).collect()
    assert [r["p"] for r in scored] == [pytest.approx(1 / (1 + math.exp(-m))) for m in odds]


def test_penalty_shrinks_the_first_step_and_is_kept(spark, data, model):
    free, held = (penalised.refit_leaves(model, data, p) for p in (0.0, 50.0))
    assert all(abs(h) < abs(f) for f, h in zip(free.values[0], held.values[0]) if f)
    folder = work_dir(spark, "test-penalised")
    learn.save_models({"catboost": held, "xgboost": model}, folder)
    loaded = learn.load_models(folder)
    assert loaded["catboost"].values == held.values and not isinstance(loaded["xgboost"], penalised.PenalisedBoost)
    both = learn.score_all(learn.score(data, held, "before"), {"after": loaded["catboost"]})
    assert both.filter("before <> after").isEmpty()


def test_search_tries_penalties(spark, data):
    grid = {"maxIter": [2], "maxDepth": [2], "l2_leaf_reg": [1, 7]}
    best, point, trials = learn.search(data.drop("weight"), "catboost", 2, 2, "id", grid=grid)
    assert isinstance(best, penalised.PenalisedBoost) and point["l2_leaf_reg"] in (1, 7)
    assert {r["params"]["l2_leaf_reg"] for r in trials.collect()} == {"1", "7"} and trials.filter("cv_f1 > 0").count() == 2
