"""Probabilities, ensemble scores and alert fields as column expressions.

Two score layouts are served. *Wide* means a ``{model: column}`` dict, null where a model gave no
score; it needs no shuffle. *Map* means one ``map<string,double>`` column, as alerts carry it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.params import DEFAULT_WEIGHT, NEUTRAL_SCORE, RiskBounds, ScoringParams

Wide = Mapping[str, Column]

# Intercept and coefficients of the stand-in scorecards.
SCORECARDS = {
    "xgboost": (-3.5, {"pay_0": 1.2, "pay_2": 0.9, "utilization_ratio": 0.3}),
    "catboost": (-2.5, {"pay_0": 1.0, "pay_2": 0.8, "months_delayed": 0.2}),
    "lightgbm": (-3.0, {"pay_0": 1.1, "max_pay_delay": 0.6, "utilization_ratio": 0.2}),
    "random_forest": (-1.0, {"avg_pay_delay": 0.5, "pay_0": 0.5, "pay_2": 0.4}),
}


def scorecard(model: str) -> Column:
    """Logistic stand-in for a fitted model, from engineered feature columns."""
    intercept, weights = SCORECARDS[model]
    z = " + ".join([f"{intercept}D", *[f"{w}D * {name}" for name, w in weights.items()]])
    return F.expr(f"1.0D / (1.0D + exp(-({z})))")


def is_number(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def at_least(score: Column, threshold: Column | float) -> Column:
    """``score >= threshold`` where NaN and null never qualify."""
    return F.coalesce(F.nanvl(score, F.lit(float("-inf"))) >= threshold, F.lit(False))


def clamp01(score: Column) -> Column:
    """Clip to [0, 1], keeping NaN as NaN.

    NaN sorts above every number, so it survives ``greatest`` but not ``least``. The score appears
    once, which keeps it from being worked out again and again inside a filter.
    """
    return F.greatest(-F.greatest(-score, F.lit(-1.0)), F.lit(0.0))


# --- one probability from whatever shape a model returns ----------------------------------------


def probability_from_map(by_class: Column) -> Column:
    """Class-1 entry, else one minus class-0, else neutral."""
    return F.coalesce(
        F.try_element_at(by_class, F.lit(1)),
        F.lit(1.0) - F.try_element_at(by_class, F.lit(0)),
        F.lit(NEUTRAL_SCORE),
    )


def probability_from_array(values: Column) -> Column:
    """Second entry of two or more, a sole entry as it is, neutral when empty."""
    return F.coalesce(
        F.try_element_at(values, F.lit(2)), F.try_element_at(values, F.lit(1)), F.lit(NEUTRAL_SCORE)
    )


# --- wide layout --------------------------------------------------------------------------------


def neutral_if_failed(scores: Wide) -> dict[str, Column]:
    """A model that failed counts as undecided but keeps its weight."""
    return {m: F.coalesce(s, F.lit(NEUTRAL_SCORE)) for m, s in scores.items()}


def weighted_mean(
    scores: Wide, weights: Mapping[str, float], default_weight: float = DEFAULT_WEIGHT
) -> Column:
    """Mean of the scores present over the weights present; neutral when there is nothing to weigh."""
    if not scores:
        return F.lit(NEUTRAL_SCORE)
    ordered = sorted(scores)
    weight = {m: F.lit(float(weights.get(m, default_weight))) for m in ordered}
    top = reduce(add, [F.coalesce(scores[m] * weight[m], F.lit(0.0)) for m in ordered])
    bottom = reduce(add, [F.when(scores[m].isNotNull(), weight[m]).otherwise(0.0) for m in ordered])
    return F.coalesce(F.when(bottom > 0, clamp01(top / bottom)), F.lit(NEUTRAL_SCORE))


def equal_mean(scores: Wide) -> Column:
    return weighted_mean(scores, {}, default_weight=1.0)


def known_weight_mean(scores: Wide, weights: Mapping[str, float]) -> Column:
    """Offline variant: models without a weight are left out; no clamp, null when none is left."""
    known = [m for m in sorted(scores) if m in weights]
    if not known:
        return F.lit(None).cast("double")
    top = reduce(add, [scores[m] * F.lit(float(weights[m])) for m in known])
    return top / F.lit(sum(float(weights[m]) for m in known))


def score_map(scores: Wide) -> Column:
    """Map of the scores present, keys in name order."""
    entries = [part for m in sorted(scores) for part in (F.lit(m), scores[m])]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


# --- map layout ---------------------------------------------------------------------------------


def _ordered_entries(scores: Column) -> Column:
    return F.array_sort(F.map_entries(scores))


def _numbers(scores: Column) -> Column:
    return F.filter(F.map_values(scores), is_number)


def map_weighted_mean(
    scores: Column, weights: Mapping[str, float], default_weight: float = DEFAULT_WEIGHT
) -> Column:
    """:func:`weighted_mean` for a map whose set of models is not known in advance."""

    def weight(entry: Column) -> Column:
        chain = F.lit(float(default_weight))
        for model, value in weights.items():
            chain = F.when(entry["key"] == model, F.lit(float(value))).otherwise(chain)
        return chain

    start = F.struct(F.lit(0.0).alias("top"), F.lit(0.0).alias("bottom"))
    return F.aggregate(
        _ordered_entries(scores),
        start,
        lambda acc, e: F.struct(
            (acc["top"] + e["value"] * weight(e)).alias("top"),
            (acc["bottom"] + weight(e)).alias("bottom"),
        ),
        lambda acc: F.coalesce(
            F.when(acc["bottom"] > 0, clamp01(acc["top"] / acc["bottom"])), F.lit(NEUTRAL_SCORE)
        ),
    )


def gated(mean: Column, scores: Column, threshold: float) -> Column:
    """Halve a mean that no single model backs at ``threshold``."""
    backed = F.exists(F.map_values(scores), lambda s: at_least(s, threshold))
    return F.when(backed, mean).otherwise(mean * F.lit(0.5))


def max_score(scores: Column) -> Column:
    return F.greatest(F.lit(0.0), F.array_max(_numbers(scores)))


def min_score(scores: Column) -> Column:
    return F.least(F.lit(1.0), F.array_min(_numbers(scores)))


def median_score(scores: Column) -> Column:
    """Middle score, mean of the middle two for an even number, neutral when there is none."""
    ordered = F.array_sort(_numbers(scores))
    size = F.size(ordered)
    upper = F.try_element_at(ordered, F.floor(size / 2).cast("int") + 1)
    lower = F.when(size > 1, F.try_element_at(ordered, F.greatest(F.floor(size / 2).cast("int"), F.lit(1))))
    middle = F.when(size % 2 == 1, upper).otherwise((lower + upper) / 2.0)
    return F.coalesce(F.when(size > 0, middle), F.lit(NEUTRAL_SCORE))


def voting_score(scores: Column, threshold: float) -> Column:
    """Share of the models at or above ``threshold``; NaN votes no but is counted."""
    votes = F.size(F.filter(F.map_values(scores), lambda s: at_least(s, threshold)))
    return F.coalesce(F.try_divide(votes.cast("double"), F.size(scores)), F.lit(0.0))


def agreement(scores: Column) -> Column:
    """One minus the population deviation (at most one); null below two scores."""
    values = F.map_values(scores)
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, s: a + s) / n
    spread = F.aggregate(
        values, F.lit(0.0), lambda a, s: a + (s - mean) * (s - mean), lambda a: F.sqrt(a / n)
    )
    return F.when(n >= 2, F.lit(1.0) - F.least(spread, F.lit(1.0)))


def wide_agreement(scores: Wide) -> Column:
    """:func:`agreement` without the map, for the hot path; every model must have a score."""
    n = len(scores)
    if n < 2:
        return F.lit(None).cast("double")
    ordered = [scores[m] for m in sorted(scores)]
    mean = reduce(add, ordered) / F.lit(float(n))
    spread = F.sqrt(reduce(add, [(s - mean) * (s - mean) for s in ordered]) / F.lit(float(n)))
    return F.lit(1.0) - F.least(spread, F.lit(1.0))


# --- strategies ---------------------------------------------------------------------------------


def ensemble_prediction(scores: Wide, params: ScoringParams) -> Column:
    """Struct of risk score, model scores and triggered models over all models."""
    filled = neutral_if_failed(scores)
    return F.struct(
        weighted_mean(filled, params.weights, params.default_weight).alias("risk_score"),
        score_map(filled).alias("model_scores"),
        triggered(filled, params.ensemble_threshold()).alias("triggered_features"),
    )


def primary_prediction(scores: Wide, params: ScoringParams) -> Column:
    """Score of the primary model alone, with two different fallbacks.

    A primary that *failed* (null) yields the whole ensemble result. A primary that is *absent*
    (not among ``scores``) yields the ensemble's score, with nothing listed beside it.
    """
    ensemble = ensemble_prediction(scores, params)
    if params.primary_model not in scores:
        return F.struct(
            ensemble["risk_score"].alias("risk_score"),
            F.create_map().cast("map<string,double>").alias("model_scores"),
            F.array().cast("array<string>").alias("triggered_features"),
        )
    alone = {params.primary_model: scores[params.primary_model]}
    primary = F.struct(
        alone[params.primary_model].alias("risk_score"),
        score_map(alone).alias("model_scores"),
        triggered(alone, params.strategy_threshold()).alias("triggered_features"),
    )
    return F.when(alone[params.primary_model].isNotNull(), primary).otherwise(ensemble)


def predict(scores: Wide, params: ScoringParams) -> Column:
    if params.strategy == "primary":
        return primary_prediction(scores, params)
    return ensemble_prediction(scores, params)


# --- alert fields -------------------------------------------------------------------------------


def triggered(scores: Wide, threshold: float) -> Column:
    """``name:0.00`` of each model strictly above the threshold, in name order."""
    items = [
        F.when(is_number(scores[m]) & (scores[m] > threshold), F.format_string(f"{m}:%.2f", scores[m]))
        for m in sorted(scores)
    ]
    return F.array_compact(F.array(*items))


def map_triggered(scores: Column, threshold: float) -> Column:
    """:func:`triggered` for the map layout."""
    over = F.filter(
        _ordered_entries(scores), lambda e: is_number(e["value"]) & (e["value"] > threshold)
    )
    return F.transform(over, lambda e: F.format_string("%s:%.2f", e["key"], e["value"]))


def scores_descending(scores: Column) -> Column:
    """Entries of a score map, highest first, name order on ties."""
    return F.array_sort(
        F.map_entries(scores),
        lambda a, b: F.when(a["value"] > b["value"], -1)
        .when(a["value"] < b["value"], 1)
        .when(a["key"] < b["key"], -1)
        .when(a["key"] > b["key"], 1)
        .otherwise(0),
    )


def risk_level(score: Column, bounds: RiskBounds = RiskBounds()) -> Column:
    return (
        F.when(at_least(score, bounds.critical), "critical")
        .when(at_least(score, bounds.high), "high")
        .when(at_least(score, bounds.medium), "medium")
        .otherwise("low")
    )


def score_bucket(score: Column) -> Column:
    """Tenth of the unit interval, 0..9; NaN and anything above land in 9, negatives in 0."""
    capped = F.when(F.isnan(score), F.lit(9.0)).otherwise(F.least(score * 10.0, F.lit(9.0)))
    return F.floor(F.greatest(capped, F.lit(0.0))).cast("int")
