"""Ensembles over long scores ``id, model, score``, for model lists not known in advance.

With a known list the wide expressions of :mod:`riskloom.functions.scoring` need no shuffle and are
the better choice. The sums here are partially aggregated, so an id with very many rows is no burden.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scoring import at_least, clamp01
from riskloom.params import DEFAULT_WEIGHT, NEUTRAL_SCORE


def parameter_table(spark: SparkSession, values: Mapping[str, float], value: str) -> DataFrame:
    """A parameter map as rows ``model, <value>``: a few literals, which Spark broadcasts by itself."""
    entries = [F.struct(F.lit(m).alias("model"), F.lit(float(v)).alias(value)) for m, v in values.items()]
    empty = F.array().cast(f"array<struct<model:string,{value}:double>>")
    return spark.range(1).select(F.inline(F.array(*entries) if entries else empty))


def override(table: DataFrame, model: str, value: float) -> DataFrame:
    """Set one entry of a parameter table, adding it if it is new."""
    column = table.columns[1]
    added = parameter_table(table.sparkSession, {model: value}, column)
    return table.filter(F.col("model") != model).unionByName(added)


def lookup(df: DataFrame, table: DataFrame, value: str, default: float) -> DataFrame:
    """Attach a model's parameter, the default where the table has none."""
    return df.join(table, "model", "left").fillna(default, [value])


def _mean_over(df: DataFrame, weight: Column) -> Column:
    present = F.when(F.col("score").isNotNull(), weight)
    return F.try_divide(F.sum(F.col("score") * weight), F.sum(present))


def weighted_mean(
    scores: DataFrame, weights: DataFrame, default_weight: float = DEFAULT_WEIGHT
) -> DataFrame:
    """Weighted mean of the scores present, neutral for an id without any."""
    weighted = lookup(scores, weights, "weight", default_weight)
    mean = clamp01(_mean_over(weighted, F.col("weight")))
    return weighted.groupBy("id").agg(F.coalesce(mean, F.lit(NEUTRAL_SCORE)).alias("ensemble"))


def known_weight_mean(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """Offline variant: models without a weight are skipped."""
    known = scores.join(weights, "model")
    return known.groupBy("id").agg(_mean_over(known, F.col("weight")).alias("ensemble"))


def plain_mean(scores: DataFrame) -> DataFrame:
    return scores.groupBy("id").agg(F.avg("score").alias("ensemble"))


def vote_fraction(scores: DataFrame, threshold: float) -> DataFrame:
    present = scores.filter(F.col("score").isNotNull())
    vote = at_least(F.col("score"), threshold).cast("double")
    return present.groupBy("id").agg(F.avg(vote).alias("votes"))


def gated_mean(scores: DataFrame, weights: DataFrame, threshold: float) -> DataFrame:
    """Weighted mean, halved for an id that no model scores at the threshold or above."""
    weighted = lookup(scores, weights, "weight", DEFAULT_WEIGHT)
    mean = F.coalesce(clamp01(_mean_over(weighted, F.col("weight"))), F.lit(NEUTRAL_SCORE))
    backed = F.coalesce(F.bool_or(at_least(F.col("score"), threshold)), F.lit(False))
    return weighted.groupBy("id").agg(F.when(backed, mean).otherwise(mean * 0.5).alias("ensemble"))


# --- layout changes -----------------------------------------------------------------------------


def to_long(wide: DataFrame, models: Sequence[str], keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row per id and model, nulls included.

    ``inline`` rather than ``unpivot``: Spark recognises two uses of its result as the same shuffle
    and runs it once, which it does not with the ``Expand`` node of an unpivot.
    """
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models]
    return wide.select(*keys, F.inline(F.array(*pairs)))


def to_wide(scores: DataFrame, models: Sequence[str], keys: Sequence[str] = ("id",)) -> DataFrame:
    """One column per model; the fixed list spares Spark a pass to find it."""
    return scores.groupBy(*keys).pivot("model", list(models)).agg(F.max("score"))


def to_map(scores: DataFrame, models: Sequence[str], keys: Sequence[str] = ("id",)) -> DataFrame:
    """One score map per id, keys in name order. Bounded by the model list, whatever the row count."""
    ordered = sorted(models)
    wide = scores.groupBy(*keys).agg(
        *[F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in ordered]
    )
    entries = F.create_map(*[part for m in ordered for part in (F.lit(m), F.col(m))])
    return wide.select(*keys, F.map_filter(entries, lambda _, v: v.isNotNull()).alias("model_scores"))


def from_map(df: DataFrame, keys: Sequence[str] = ("id",), column: str = "model_scores") -> DataFrame:
    return df.select(*keys, F.explode(column).alias("model", "score"))
