"""Isolation forest: anomaly scores from randomly grown trees.

Each tree is grown from a small uniform sample (256 rows by default), as the published algorithm
has it, so growing is one bounded group per tree. The fitted forest is a table of nodes, at most
``2 * sample - 1`` per tree whatever the data; it is shipped to the tasks that score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.session import ensure_checkpoint_dir, ship_package

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, split double, left int, right int, path double"


def average_path(n: int) -> float:
    """Expected path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class IsolationForest:
    """Fitted nodes with what scoring needs to know about them."""

    nodes: DataFrame
    features: tuple[str, ...]
    sample: int

    def save(self, folder: str) -> None:
        self.nodes.withColumn("sample", F.lit(self.sample)).write.mode("errorifexists").parquet(folder)

    @staticmethod
    def load(spark: SparkSession, folder: str, features: Sequence[str]) -> IsolationForest:
        saved = spark.read.parquet(folder)
        return IsolationForest(saved.drop("sample"), tuple(features), saved.agg(F.max("sample")).first()[0])


def _takers(key: str, trees: int, share: float, seed: int) -> tuple[Column, Column]:
    """(first, all): the trees that a row with this key passes for, each with probability ``share``.

    The gap to the next one is drawn at once, from a geometric distribution, so trees that don't take the row cost
    nothing. ``first`` is not below ``trees`` if none does.
    """
    scale = math.log1p(-share) if share < 1 else -math.inf

    def gap(after: Column) -> Column:
        uniform = (F.pmod(F.xxhash64(F.lit(seed), F.lit("gap"), after, key), F.lit(1 << 53)) + 0.5) / F.lit(float(1 << 53))
        return F.floor(F.ln(uniform) / F.lit(scale)).cast("long")

    first = gap(F.lit(-1).cast("long"))
    start = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("taken"))

    def step(state: Column, _: Column) -> Column:
        onward = F.struct((state["at"] + 1 + gap(state["at"])).alias("at"), F.array_append(state["taken"], state["at"]).alias("taken"))
        return F.when(state["at"] < trees, onward).otherwise(state)

    return first, F.aggregate(F.sequence(F.lit(1), F.lit(trees)), start, step, lambda state: state["taken"])


def draw_samples(
    df: DataFrame, key: str, features: Sequence[str], trees: int, sample: int, seed: int, rows: int
) -> DataFrame:
    """``sample`` uniform rows of all ``rows`` for each tree, without replacement within a tree.

    A little more than ``sample`` rows pass per tree, and those with the smallest hashes of tree and key are its
    sample. So every tree draws from the whole table in one pass, and only rows that pass are made and moved.
    """
    enough = sample + 8 * math.sqrt(sample) + 16
    first, taken = _takers("_key", trees, min(1.0, enough / max(rows, 1)), seed)
    keyed = df.select(F.col(key).alias("_key"), F.array(*[F.col(c).cast("double") for c in features]).alias("values"))
    passed = keyed.filter(first < trees).select("_key", "values", F.explode(taken.cast("array<int>")).alias("tree"))
    order = W.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed), "tree", "_key"), "_key")
    ranked = passed.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= sample)
    return ranked.select("tree", "_rank", "_key", "values")


def _grow(rows: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    nodes: list[tuple] = []
    waiting = [(rows, 0, None, "")]
    while waiting:
        part, depth, parent, side = waiting.pop()
        number = len(nodes)
        if parent is not None:
            nodes[parent] = nodes[parent]._replace(**{side: number})
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (None, None)
        varied = np.flatnonzero(high > low) if len(part) > 1 and depth < limit else []
        if len(varied) == 0:
            nodes.append(_Node(number, -1, 0.0, -1, -1, depth + average_path(len(part))))
            continue
        feature = int(rng.choice(varied))
        split = float(rng.uniform(low[feature], high[feature]))
        nodes.append(_Node(number, feature, split, -1, -1, 0.0))
        below = part[:, feature] <= split
        waiting.append((part[~below], depth + 1, number, "right"))
        waiting.append((part[below], depth + 1, number, "left"))
    return nodes


@dataclass(frozen=True)
class _Node:
    node: int
    feature: int
    split: float
    left: int
    right: int
    path: float

    def _replace(self, **changes: int) -> _Node:
        return _Node(**{**self.__dict__, **changes})


def fit(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    label: str | None = "is_default",
    trees: int = 200,
    sample: int = 256,
    seed: int = 42,
) -> IsolationForest:
    """Grow a forest on the normal rows only (all rows without a label).

    With fewer normal rows than ``sample``, each tree takes them all; height limit, path correction
    and the saved model then go by their number.
    """
    normal = df.filter(F.col(label) == 0) if label else df
    rows = normal.count()
    if not rows:
        raise ValueError("an isolation forest needs normal rows")
    sample = min(sample, rows)
    limit = max(1, math.ceil(math.log2(sample)))

    def grow(batch: pd.DataFrame) -> pd.DataFrame:
        tree = int(batch["tree"].iloc[0])
        drawn = np.stack(batch.sort_values("_rank")["values"].to_numpy())
        drawn = np.nan_to_num(np.asarray(drawn, dtype=float))
        grown = _grow(drawn, limit, np.random.default_rng([seed, tree]))
        return pd.DataFrame([{"tree": tree, **n.__dict__} for n in grown])

    samples = draw_samples(normal, key, features, trees, sample, seed, rows)
    # Kept once: growing again after a lost task would be wasteful, not different.
    ensure_checkpoint_dir(df.sparkSession)
    ship_package(df.sparkSession)
    nodes = samples.groupBy("tree").applyInPandas(grow, NODES).checkpoint()
    return IsolationForest(nodes, tuple(features), sample)


def score(df: DataFrame, forest: IsolationForest, name: str = "raw_score") -> DataFrame:
    """Append the raw score, low for anomalies: 0.5 less the anomaly score ``2^(-path / c)``.

    What the driver holds is the forest itself, a few thousand numbers per tree at most.
    """
    ship_package(df.sparkSession)
    table = forest.nodes.orderBy("tree", "node").toPandas()
    grown = [
        tuple(t[c].to_numpy() for c in ("feature", "split", "left", "right", "path"))
        for _, t in table.groupby("tree")
    ]
    shared = df.sparkSession.sparkContext.broadcast(grown)
    expected = average_path(forest.sample) or 1.0  # one row has no path to speak of

    @F.pandas_udf("double")
    def raw(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.nan_to_num(np.stack(batch.to_numpy()).astype(float))
            total = np.zeros(len(rows))
            every = np.arange(len(rows))
            for feature, split, left, right, path in shared.value:
                at = np.zeros(len(rows), dtype=int)
                inner = feature[at] >= 0
                while inner.any():
                    here = at[inner]
                    below = rows[every[inner], feature[here]] <= split[here]
                    at[inner] = np.where(below, left[here], right[here])
                    inner = feature[at] >= 0
                total += path[at]
            yield pd.Series(0.5 - np.power(2.0, -total / len(shared.value) / expected))

    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in forest.features])
    return df.withColumn(name, raw(values))
