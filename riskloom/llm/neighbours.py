"""Approximate nearest neighbours: an NN-descent graph, searched greedily.

Vectors that are equal are one node. A node's first list of neighbours comes from small groups: a few
sets of random hyperplanes, and one purely random grouping, each cut into groups of bounded size that are
compared inside. NN-descent then joins neighbours of neighbours: every node brings together its
neighbours and those that have it as a neighbour, and each learns of the others if they are nearer than
the last of its list. Only pairs with a member that is new since the last round meet. Nodes are dealt to
shards by where they lie, and a shard is sent each vector it needs once, not once per edge.

A query starts at its own node's list and goes on from the nearest nodes not yet followed, until all of
the nearest ``BREADTH`` were. Final distances are worked out from the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import kept, map_arrow, table
from riskloom.session import shuffle_partitions

NEAREST = 10
QUERY_STEP = 100
#: Neighbours that a node keeps, and the most that it is told of by others in a round.
LIST = 24
#: Sets of hyperplanes, and the mean size of a group that is compared inside.
TREES, LEAF = 4, 400
#: Rounds of NN-descent at most; they end sooner when fewer than this share of all list entries is new.
ROUNDS, FEW_NEW = 4, 0.05
#: Nodes, and queries, of a shard at most, in the mean. Where near nodes lie together, a shard's nodes share
#: most of their neighbours; where they don't, larger shards would come to need all vectors.
SHARD_NODES, SHARD_QUERIES = 512, 64
#: Nearest nodes that a search follows before it ends, and how many of them in one step.
BREADTH, STEP = 300, 150
#: Nearest nodes of a search that are compared exactly.
EXACT = 40
SEED = 11
#: Nodes whose pairs are worked out at a time, and pairs that are held before they are trimmed.
BLOCK, HELD_PAIRS = 128, 4_000_000


# --- vectors, groups and shards -----------------------------------------------------------------


def valid_vectors(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part: an id, and a vector with finite components, one not zero."""
    chosen = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return chosen.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def distinct_vectors(data: DataFrame) -> DataFrame:
    """(id, vec) with a unique id per vector: the smallest ``vec_id`` that has it.

    Where an id has several vectors and is the smallest of more than one, those get negative numbers
    beyond -2^62 instead, where no id is expected.
    """
    firsts = kept(data.groupBy("vec").agg(F.min("vec_id").alias("first")), "vectors")
    twice = firsts.groupBy("first").count().filter("count > 1").select("first", F.lit(True).alias("twice"))
    other = F.lit(-(1 << 62)) - F.monotonically_increasing_id()
    return firsts.join(twice, "first", "left").select(F.when(F.col("twice"), other).otherwise(F.col("first")).alias("id"), "vec")


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind: type = np.float32) -> np.ndarray:
    """A column of equally long lists as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, dim)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, kind))


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Sorted batches put together so that rows equal in the first ``keys`` columns stay together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        if held:
            before = [held[-1].column(k)[-1].as_py() for k in range(keys)]
            columns = [np.r_[b, c] for b, c in zip(before, columns)]
        turns = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + (0 if held else 1)
        if len(turns):
            cut = int(turns[-1])
            done = [*held, batch.slice(0, cut)]
            yield pa.Table.from_batches(done).combine_chunks()
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)])


def _spread(nodes: DataFrame, dim: int) -> tuple[np.ndarray, float]:
    """The mean vector and the largest component apart from it; from one row per component and task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low, high, n = np.zeros(dim), np.full(dim, np.inf), np.full(dim, -np.inf), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1), dim, np.float64)
                total, n = total + (x / 2**10).sum(axis=0), n + len(x)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
        if n:
            columns = [pa.array(np.arange(dim)), pa.array(total), pa.array(low), pa.array(high), pa.array(np.full(dim, n))]
            yield pa.RecordBatch.from_arrays(columns, ["k", "total", "low", "high", "n"])

    parts = map_arrow(nodes, sums, "k long, total double, low double, high double, n long")
    whole = parts.groupBy("k").agg(F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    rows = sorted(whole.collect())
    low, high = np.array([r["low"] for r in rows]), np.array([r["high"] for r in rows])
    width = float(np.max(high / 2 - low / 2)) or 1.0
    # Rounded, so that the order in which tasks add up does not show.
    mean = np.array([r["total"] / r["n"] * 2**10 for r in rows])
    return np.round(mean / width, 6) * width, width


def _points(nodes: DataFrame, dim: int, bits: int) -> DataFrame:
    """(id, x, codes): centred and scaled vectors, and on which sides of each tree's hyperplanes they lie."""
    mean, width = _spread(nodes, dim)
    planes = np.random.default_rng(SEED).standard_normal((dim, TREES * bits)).astype(np.float32)
    weights = 1 << np.arange(bits, dtype=np.int64)[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = ((_matrix(batch.column(1), dim, np.float64) - mean) / width).astype(np.float32)
            codes = ((x @ planes) > 0).reshape(len(x), TREES, bits) @ weights
            columns = [
                batch.column(0),
                _lists(x.ravel(), np.full(len(x), dim), pa.float32()),
                _lists(codes.ravel(), np.full(len(x), TREES), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "x", "codes"])

    return map_arrow(nodes, run, "id long, x array<float>, codes array<long>")


def _dealt(rows: DataFrame, group: list[str], most: int) -> DataFrame:
    """Append ``part``: groups with more than ``most`` rows are dealt by hash into as many parts as they need."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / most)
    return rows.join(sizes, group).withColumn("part", F.pmod(F.xxhash64("id", *group), parts)).drop("size")


# --- lists of neighbours ------------------------------------------------------------------------


def _nearest(owner: np.ndarray, other: np.ndarray, far: np.ndarray, new: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Each owner's ``most`` nearest others once each, nearest first; of repeats the one that is not new."""
    order = np.lexsort((new, other, owner))
    owner, other, far, new = owner[order], other[order], far[order], new[order]
    once = np.ones(len(owner), bool)
    once[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, far, new = owner[once], other[once], far[once], new[once]
    order = np.lexsort((other, far, owner))
    owner, other, far, new = owner[order], other[order], far[order], new[order]
    starts = _starts(owner) if len(owner) else np.empty(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(starts, np.diff(np.r_[starts, len(owner)]))
    keep = rank < most
    return owner[keep], other[keep], far[keep], new[keep]


def _list_batch(owner: np.ndarray, other: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    starts = _starts(owner) if len(owner) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(owner)])
    return pa.RecordBatch.from_arrays(
        [pa.array(owner[starts], pa.int64()), _lists(other, sizes, pa.int64()), _lists(far, sizes, pa.float32())], ["id", "near", "far"]
    )


def _group_lists(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists from rows (tree, code, part, id, x): the nearest inside each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _whole_groups(batches, 3):
            tree, code, part, ids = (groups.column(k).to_numpy() for k in range(4))
            x = _matrix(groups.column(4), dim)
            starts = _starts(tree, code, part)
            for a, b in zip(starts, np.r_[starts[1:], len(ids)]):
                if b - a < 2:
                    continue
                far = _squares(x[a:b], x[a:b])
                np.fill_diagonal(far, np.inf)
                most = min(LIST, b - a - 1)
                near = np.argpartition(far, most - 1, axis=1)[:, :most]
                owner = np.repeat(ids[a:b], most)
                yield _list_batch(owner, ids[a:b][near].ravel(), np.take_along_axis(far, near, 1).ravel())

    return run


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of the last two axes."""
    square = lambda x: np.einsum("...ij,...ij->...i", x, x)
    return np.maximum(square(a)[..., :, None] + square(b)[..., None, :] - 2 * a @ np.swapaxes(b, -1, -2), 0)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One list per node from rows (id, near, far, old) sorted by id; ``fresh`` are those of no old row."""
    for lists in _whole_groups(batches, 1):
        near, far = lists.column(1).combine_chunks(), lists.column(2).combine_chunks()
        sizes = pc.list_value_length(near).to_numpy()
        owner = np.repeat(lists.column(0).to_numpy(), sizes)
        new = ~np.repeat(lists.column(3).to_numpy(zero_copy_only=False).astype(bool), sizes)
        owner, other, far, new = _nearest(owner, near.flatten().to_numpy(), far.flatten().to_numpy(), new, LIST)
        batch = _list_batch(owner, other, far)
        fresh = pa.ListArray.from_arrays(batch.column(1).offsets, pa.array(new))
        yield pa.RecordBatch.from_arrays([*batch.columns, fresh], ["id", "near", "far", "fresh"])


def _merged(lists: DataFrame, tasks: int) -> DataFrame:
    ordered = lists.select("id", "near", "far", "old").repartition(tasks, "id").sortWithinPartitions("id")
    return map_arrow(ordered, _merge, "id long, near array<long>, far array<float>, fresh array<boolean>")


def _members(graph: DataFrame, turn: int) -> DataFrame:
    """(id, members, flags): a node's list and up to LIST of the nodes that list it, new ones first."""
    edges = graph.select("id", F.inline(F.arrays_zip("near", "fresh"))).select(F.col("near").alias("id"), F.col("id").alias("other"), "fresh")
    order = W.partitionBy("id").orderBy(F.desc("fresh"), F.xxhash64("id", "other", F.lit(turn)))
    told = edges.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= LIST)
    back = told.groupBy("id").agg(F.collect_list(F.struct("other", "fresh")).alias("back"))
    both = graph.join(back, "id", "left").withColumn("back", F.coalesce("back", F.array().cast("array<struct<other:bigint,fresh:boolean>>")))
    return both.select("id", F.concat("near", "back.other").alias("members"), F.concat("fresh", "back.fresh").alias("flags"))


def _local_join(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What nodes learn in shards of rows (shard, id, x, limit, members, flags).

    Rows with ``x`` are the shard's vectors, with the distance that a new neighbour must beat; the others
    are the nodes whose members meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _whole_groups(batches, 1):
            starts = _starts(shards.column(0).to_numpy())
            for a, b in zip(starts, np.r_[starts[1:], shards.num_rows]):
                yield _learned(shards.slice(a, b - a), dim)

    return run


def _learned(shard: pa.Table, dim: int) -> pa.RecordBatch:
    items = shard.filter(pc.is_valid(shard.column(2)))
    ids = items.column(1).to_numpy()
    by = np.argsort(ids)
    ids, x, limit = ids[by], _matrix(items.column(2), dim)[by], items.column(3).to_numpy()[by]
    centres = shard.filter(pc.is_valid(shard.column(4)))
    members = centres.column(4).combine_chunks()
    sizes = pc.list_value_length(members).to_numpy()
    places = np.searchsorted(ids, members.flatten().to_numpy())
    flags = centres.column(5).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    held: list[tuple[np.ndarray, ...]] = []
    count = 0

    def trim() -> None:
        owner, other, far = (np.concatenate(c) for c in zip(*held))
        held[:] = [_nearest(owner, other, far, np.ones(len(owner), bool), LIST)[:3]]

    for first in range(0, len(sizes), BLOCK):
        some = sizes[first : first + BLOCK]
        wide = int(some.max())
        nth = np.arange(wide)
        there = nth < some[:, None]
        at = np.minimum(begins[first : first + BLOCK, None] + nth, len(places) - 1)
        who, new = np.where(there, places[at], -1), flags[at] & there
        far = _squares(x[who], x[who])
        meet = (new[:, :, None] | new[:, None, :]) & there[:, :, None] & there[:, None, :] & (who[:, :, None] != who[:, None, :])
        meet &= far < limit[who][:, :, None]
        g, i, j = np.nonzero(meet)
        held.append((who[g, i], who[g, j], far[g, i, j]))
        count += len(g)
        if count > HELD_PAIRS:
            trim()
            count = len(held[0][0])
    if not held:
        return _list_batch(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32))
    trim()
    owner, other, far = held[0]
    return _list_batch(ids[owner], ids[other], far)


def _sent(shards: DataFrame, wanted: Column, vectors: DataFrame, tasks: int) -> DataFrame:
    """Each shard's rows and, once each, the vectors of the nodes that ``wanted`` lists, shard by shard."""
    asked = shards.select("shard", F.explode(wanted).alias("id")).distinct()
    every = shards.unionByName(asked.join(vectors, "id"), allowMissingColumns=True)
    return every.repartition(tasks, "shard").sortWithinPartitions("shard")


class Graph:
    """The neighbour graph of distinct vectors of one length.

    ``nodes`` has a row (id, vec) for each. ``points`` are the vectors as worked with, ``homes`` the
    shards, ``lists`` the neighbours, nearest first, with squared distances between points.
    """

    def __init__(self, nodes: DataFrame, dim: int):
        spark = nodes.sparkSession
        self.dim, self.n = dim, nodes.count()
        self.tasks = max(shuffle_partitions(spark), -(-self.n // 50_000))
        bits = max(0, math.ceil(math.log2(max(1, self.n / LEAF))))
        coarse = max(0, math.floor(math.log2(max(1, self.n / SHARD_NODES))))
        points = kept(_points(nodes, dim, bits), "points")
        self.points = points.select("id", "x")
        where = points.select("id", F.shiftright(F.col("codes")[0], bits - coarse).alias("prefix"))
        shard = F.shiftleft("prefix", 24) + F.col("part")
        self.homes = kept(_dealt(where, ["prefix"], SHARD_NODES).select("id", shard.alias("shard")), "homes")
        # The tree after the last one has no planes: its groups are random.
        trees = F.concat("codes", F.array(F.lit(0).cast("long")))
        leaves = _dealt(points.select("id", F.posexplode(trees).alias("tree", "code")), ["tree", "code"], LEAF)
        key = ["tree", "code", "part"]
        grouped = leaves.join(self.points, "id").select(*key, "id", "x").repartition(self.tasks, *key).sortWithinPartitions(*key)
        first = map_arrow(grouped, _group_lists(dim), "id long, near array<long>, far array<float>")
        self.lists = kept(_merged(first.withColumn("old", F.lit(False)), self.tasks), "neighbours")
        for turn in range(ROUNDS):
            self.lists = self._round(turn)
            new = self.lists.agg(F.sum(F.size(F.filter("fresh", lambda f: f))), F.sum(F.size("fresh"))).head()
            if (new[0] or 0) <= FEW_NEW * (new[1] or 0):
                break

    def _round(self, turn: int) -> DataFrame:
        """Lists after all members of each node that has new ones have met."""
        meeting = _members(self.lists, turn).filter(F.exists("flags", lambda f: f))
        centres = kept(meeting.join(self.homes, "id").select("shard", "id", "members", "flags"), "centres")
        last = F.when(F.size("far") >= LIST, F.element_at("far", -1)).otherwise(F.lit(float("inf"))).cast("float")
        vectors = self.points.join(self.lists.select("id", last.alias("limit")), "id", "left").fillna(float("inf"), ["limit"])
        sent = _sent(centres, F.col("members"), vectors, self.tasks)
        order = ["shard", "id", "x", "limit", "members", "flags"]
        learned = map_arrow(sent.select(*order), _local_join(self.dim), "id long, near array<long>, far array<float>")
        both = self.lists.select("id", "near", "far", F.lit(True).alias("old")).unionByName(learned.withColumn("old", F.lit(False)))
        return kept(_merged(both, self.tasks), "neighbours")

    def search(self, ids: DataFrame, breadth: int = BREADTH, step: int = STEP) -> DataFrame:
        """(id, near): the nearest nodes found for each node of ``ids``, nearest first, without itself."""
        links = kept(_members(self.lists, ROUNDS).select(F.col("id").alias("node"), "members"), "links")
        n_queries = ids.count()
        parts = max(1, math.ceil(SHARD_NODES * n_queries / max(1, self.n) / SHARD_QUERIES))
        shard = F.xxhash64("shard", F.pmod(F.xxhash64("id"), F.lit(parts)))
        begun = ids.join(self.homes, "id").withColumn("shard", shard).join(self.points.withColumnRenamed("x", "from"), "id")
        none = lambda kind: F.array().cast(kind)
        begun = begun.join(self.lists.select("id", "near", "far"), "id", "left").select(
            "shard", "id", "from",
            F.coalesce("near", none("array<bigint>")).alias("near"),
            F.coalesce("far", none("array<float>")).alias("far"),
        )
        state = begun.withColumns({
            "front": F.slice("near", 1, step),
            "done": F.slice("near", 1, step),
            "seen": F.concat("near", F.array("id")),
        })
        state = kept(state, "search")
        while state.filter(F.size("front") > 0).limit(1).count():
            followed = state.select("id", F.explode("front").alias("node")).join(links, "node")
            told = followed.select("id", F.explode("members").alias("other")).groupBy("id").agg(F.collect_set("other").alias("told"))
            fresh = F.array_except(F.coalesce("told", none("array<bigint>")), "seen")
            asked = kept(state.drop("front").join(told, "id", "left").withColumn("asked", fresh).drop("told"), "asked")
            sent = _sent(asked, F.col("asked"), self.points, self.tasks)
            names = ["shard", "id", "x", "from", "near", "far", "done", "seen", "asked"]
            state = map_arrow(
                sent.select(*names),
                _advance(self.dim, breadth, step),
                "shard long, id long, from array<float>, near array<long>, far array<float>, front array<long>, done array<long>, seen array<long>",
            )
            state = kept(state, "search")
        return state.select("id", "near")


def _advance(dim: int, breadth: int, step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One step of the searches in shards of rows (shard, id, x, from, near, far, done, seen, asked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shards in _whole_groups(batches, 1):
            starts = _starts(shards.column(0).to_numpy())
            for a, b in zip(starts, np.r_[starts[1:], shards.num_rows]):
                yield advanced(shards.slice(a, b - a))

    def advanced(shard: pa.Table) -> pa.RecordBatch:
        items = shard.filter(pc.is_valid(shard.column(2)))
        ids = items.column(1).to_numpy()
        by = np.argsort(ids)
        ids, x = ids[by], _matrix(items.column(2), dim)[by]
        queries = shard.filter(pc.is_valid(shard.column(3)))
        points = _matrix(queries.column(3), dim)
        rows: dict[str, list[np.ndarray]] = {name: [] for name in ("near", "far", "front", "done", "seen")}
        for q in range(queries.num_rows):
            near, far, done, seen, asked = (queries.column(k)[q].values.to_numpy(zero_copy_only=False) for k in range(4, 9))
            apart = x[np.searchsorted(ids, asked)] - points[q]
            near, far = np.r_[near, asked], np.r_[far, np.einsum("ij,ij->i", apart, apart)]
            best = np.lexsort((near, far))[:breadth]
            near, far = near[best], far[best]
            front = near[~np.isin(near, done)][:step]
            for name, value in zip(rows, (near, far, front, np.r_[done, front], np.r_[seen, asked])):
                rows[name].append(value)
        kinds = {"far": pa.float32()}
        made = [
            _lists(np.concatenate(v) if v else np.empty(0), np.array([len(r) for r in v], np.int64), kinds.get(name, pa.int64()))
            for name, v in rows.items()
        ]
        columns = [*(queries.column(k).combine_chunks() for k in (0, 1, 3)), *made]
        return pa.RecordBatch.from_arrays(columns, ["shard", "id", "from", *rows])

    return run


# --- the operator -------------------------------------------------------------------------------


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of equal length, summed in order in double precision."""
    apart = lambda x, y: x.cast("double") - y.cast("double")
    squares = F.zip_with(a, b, lambda x, y: apart(x, y) * apart(x, y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, s: total + s))


def nearest_neighbours(
    rows: DataFrame,
    queries: Column | str,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest rows, smallest distance first, ties by id.

    ``queries`` is a condition on the column ``vec_id``. Rows without an id and vectors that are null, empty,
    all zero or hold a null or non-finite component take no part; vectors of different lengths are no
    neighbours. A row that repeats an id and its vector counts once; an id with several vectors is
    several queries. Other columns are not looked at. The result is approximate; the tests measure its recall.
    """
    data = valid_vectors(rows, vec_id, vector)
    nodes = kept(distinct_vectors(data), "nodes")
    members = kept(data.join(nodes, "vec").select("vec_id", "id").distinct(), "members")
    sizes = sorted(r[0] for r in nodes.select(F.size("vec")).distinct().collect())
    asking = members.filter(queries)
    copies = _first_copies(members, nearest + 1)
    found: DataFrame | None = None
    for dim in sizes:
        alike = nodes.filter(F.size("vec") == dim)
        graph = Graph(alike, dim)
        ids = asking.select("id").distinct().join(alike.select("id"), "id")
        near = graph.search(kept(ids, "query-nodes"))
        pairs = near.select("id", F.explode(F.slice("near", 1, max(EXACT, nearest + 1))).alias("other"))
        exact = pairs.join(alike, "id").withColumnRenamed("vec", "a").join(alike.select(F.col("id").alias("other"), F.col("vec").alias("b")), "other")
        measured = exact.select("id", "other", distance(F.col("a"), F.col("b")).alias("score"))
        found = measured if found is None else found.union(measured)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = asking.select("id").distinct().select("id", F.col("id").alias("other"), F.lit(0.0).alias("score"))
    spread = found.union(own).join(copies.withColumnRenamed("id", "other"), "other")
    order = W.partitionBy("id").orderBy("score", "vec_id")
    first = spread.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= nearest + 1)
    listed = first.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("listed"))
    answers = asking.withColumnRenamed("vec_id", "query_id").join(listed, "id")
    others = F.slice(F.filter("listed", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest)
    return answers.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score"
    )


def _first_copies(members: DataFrame, most: int) -> DataFrame:
    """(id, vec_id): of each node's rows those with the smallest ids, as many as any query can return."""
    order = W.partitionBy("id").orderBy("vec_id")
    return members.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).drop("nth")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), f"vec_id % {QUERY_STEP} = 0")
