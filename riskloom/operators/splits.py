"""Seeded splits and folds by rank of a key's digest.

Sizes are exact and membership depends on key and seed alone, whatever the partitioning. Splits find
one cut per class and compare digests with it; folds rank all rows through digest slices, so a class
of any size is ranked by many tasks. The key must be unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.running import SLICE, running_totals, slice_by_hash


def digest(key: str, seed: str = "") -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))


def ranked(df: DataFrame, key: str, by: Sequence[str] = (), seed: str = "") -> DataFrame:
    """Append ``split_rank`` (from 1) within each group and ``split_size`` (rows of the group)."""
    hashed = slice_by_hash(df.withColumn("_digest", digest(key, seed)), "_digest")
    summed = running_totals(hashed, list(by), [F.asc("_digest"), F.asc(key)], {"n": F.lit(1)})
    return summed.withColumnsRenamed({"cum_n": "split_rank", "all_n": "split_size"}).drop(
        "_digest", SLICE
    )


def _cut(df: DataFrame, key: str, by: Sequence[str], fraction: float, names: tuple[str, str], seed: str) -> DataFrame:
    """Append ``split``: of each class the ``floor(fraction * n)`` rows with the smallest digests are the first part.

    Only keys and classes are read to find the cut: digests are counted by their first digits, and the
    rows of the one cell per class in which the cut falls are ranked. The table itself is then marked by
    comparing digests, without moving a row. Cut points, one row per class, go to every task.
    """
    group = list(by) or ["_all"]
    keyed = df.select(*(F.col(c) for c in by), F.col(key).alias("_key"), digest(key, seed).alias("_digest"))
    keyed = (keyed if by else keyed.withColumn("_all", F.lit(0))).withColumn("_cell", F.substring("_digest", 1, 3))
    cells = keyed.groupBy(*group, "_cell").agg(F.count("*").alias("_n"))
    within = W.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(within.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    want = F.floor(F.sum("_n").over(within) * F.lit(fraction))
    placed = cells.select(*group, "_cell", "_n", (want - before).alias("_need"))
    cut = placed.filter((F.col("_need") > 0) & (F.col("_need") <= F.col("_n"))).alias("c")
    same = F.col("k._cell") == F.col("c._cell")
    for c in group:
        same = same & F.col(f"k.{c}").eqNullSafe(F.col(f"c.{c}"))
    inside = keyed.alias("k").join(F.broadcast(cut), same).select("k.*", "c._need")
    order = within.orderBy("_digest", "_key")
    last = inside.withColumn("_rank", F.row_number().over(order)).filter("_rank = _need")
    points = last.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.struct("_digest", "_key").alias("_last"))
    match = F.lit(True)
    for c in group:
        match = match & (F.col(c).eqNullSafe(F.col(f"_of_{c}")) if by else F.col(f"_of_{c}") == 0)
    own = F.struct(digest(key, seed).alias("_digest"), F.col(key).alias("_key"))
    part = F.when(F.col("_last").isNotNull() & (own <= F.col("_last")), names[0]).otherwise(names[1])
    return df.join(F.broadcast(points), match, "left").withColumn("split", part).select(*df.columns, "split")


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    fraction: float = 0.8,
    names: tuple[str, str] = ("train", "test"),
    seed: str = "",
) -> DataFrame:
    """Append ``split``: ``fraction`` of each class, rounded down, is the first part."""
    return _cut(df, key, [label], fraction, names, seed)


def validation_split(
    df: DataFrame, key: str, label: str, fraction: float = 0.1, seed: str = "v"
) -> DataFrame:
    """Stratified split that sets ``fraction`` of the rows aside for validation."""
    return stratified_split(df, key, label, fraction, ("validation", "train"), seed)


def simple_validation_split(df: DataFrame, key: str, fraction: float = 0.1, seed: str = "") -> DataFrame:
    """Exactly ``floor(fraction * n)`` validation rows, whatever their class."""
    return _cut(df, key, [], fraction, ("validation", "train"), seed)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 3, seed: str = "") -> DataFrame:
    """Append ``fold`` 0..k-1; fold sizes within a class differ by one at most."""
    numbered = ranked(df, key, [label], seed)
    return numbered.withColumn("fold", ((F.col("split_rank") - 1) % k).cast("int")).drop(
        "split_rank", "split_size"
    )
