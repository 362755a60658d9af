"""Connected components by contraction, without a group that any task must hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import settled


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root names the component.

    Each round, every node points at the neighbour that comes first in a fixed random order, or at
    itself, and edges are rewritten to what their ends point at. A third or so of the nodes goes per
    round whatever the shape, so rounds grow with the logarithm of the edges; a star takes two.
    Only sums per node and joins on unique keys are needed, so busy nodes may be split by the engine.
    """
    order = lambda c: F.struct(F.xxhash64(c).alias("draw"), F.col(c).alias("node"))
    edges = settled(edges.select("a", "b").filter("a <> b").distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(order("b")).alias("first"))
        points = settled(
            first.select(F.col("a").alias("node"), F.least(F.col("first"), order("a"))["node"].alias("to"))
        )
        steps.append(points)
        ahead = edges.join(points.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        ahead = ahead.join(points.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = settled(
            ahead.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), "to")
        found = found.join(later, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return found
