"""SimHash near-duplicates: a self-join of binary tries under an error budget.

Fingerprints are compared once per distinct value. At most four of 64 bits may differ, so of five
blocks of bits one agrees; fingerprints meet in groups that agree on a block, and inside a group a
trie joins with itself: node pairs go down together, the bits in which they differ add up, and a pair
is dropped as soon as it is over budget. A group above ``GROUP_ROWS`` is not cut short but split
again by five blocks of its free bits, as often as needed; distinct values with 14 free bits are
fewer than that, so it ends. What leaves a task is a spanning forest, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, settled, table, text_bytes
from riskloom.llm.components import components
from riskloom.session import shuffle_partitions

BITS = 64
BUDGET = 4
SHINGLE_WORDS = 4
SEED = 42
#: A group up to this size is one trie of one task.
GROUP_ROWS = 20_000
#: Rows of all groups that one task holds.
TASK_ROWS = 1_000_000
#: Hash values turned to bits at a time, and node pairs followed at a time.
HASHES = 100_000
NODE_PAIRS = 200_000
#: Node pairs with so few leaf pairs are compared directly.
LEAF_PAIRS = 16


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the SimHash of each whole text as a signed long.

    ASCII letters count in lower case; words end at ASCII white space; shingles of four words count
    as often as they occur; a shorter text is one shingle; without words the value is 0.
    """
    return map_arrow(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), _hash_batches, "doc_id long, fp long")


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = text_bytes(batch.column(1))
        values = simhashes(data[at[i] : at[i + 1]].tobytes() for i in range(batch.num_rows))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(values.view(np.int64))], ["doc_id", "fp"])


def shingles(text: bytes) -> tuple[bytes, list[int], list[int]]:
    """The words joined by single spaces, and where each shingle begins and ends in that."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= SHINGLE_WORDS:
        return joined, [0] * bool(words), [len(joined)] * bool(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return joined, starts[: 1 - SHINGLE_WORDS].tolist(), ends[SHINGLE_WORDS - 1 :].tolist()


def simhashes(texts: Iterator[bytes]) -> np.ndarray:
    """Fingerprints of texts as unsigned 64-bit numbers."""
    ones: list[np.ndarray] = []
    totals: list[int] = []
    held: list[int] = []
    owners: list[tuple[int, int]] = []  # text and its number of values in held

    def count() -> None:
        if held:
            bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1)
            begins = np.cumsum([0] + [n for _, n in owners[:-1]])
            for (i, _), add in zip(owners, np.add.reduceat(bits, begins, axis=0, dtype=np.int64), strict=True):
                ones[i] += add
            held.clear()
            owners.clear()

    hashed = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        joined, starts, ends = shingles(text)
        ones.append(np.zeros(BITS, np.int64))
        totals.append(len(starts))
        for k in range(0, len(starts), HASHES):
            values = [hashed(joined[a:b], SEED) for a, b in zip(starts[k : k + HASHES], ends[k : k + HASHES], strict=True)]
            held += values
            owners.append((i, len(values)))
            if len(held) >= HASHES:
                count()
    count()
    if not ones:
        return np.empty(0, np.uint64)
    return np.packbits(2 * np.array(ones) > np.array(totals)[:, None], axis=1).view("<u8").ravel()


def _split(mask: int, parts: int = BUDGET + 1) -> list[int]:
    """The masks that also fix one of ``parts`` even blocks of the bits that ``mask`` leaves free."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [_signed(mask | sum(1 << b for b in block.tolist())) for block in np.array_split(np.array(free), parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def links(prints: DataFrame, group_rows: int = GROUP_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Edges (a, b) between distinct ``fp`` values whose components are those of all linked pairs.

    ``prints`` has unique, non-null values of ``fp``. Equal values are one node and need no edge.
    """
    masks = _split(0)
    rows = prints.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    done: list[DataFrame] = []
    total = len(masks) * prints.count()
    while True:
        keyed = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        heavy = settled(keyed.groupBy("mask", "key").count().filter(F.col("count") > group_rows).select("mask", "key"))
        if heavy.isEmpty():
            done.append(keyed)
            break
        done.append(keyed.join(heavy, ["mask", "key"], "left_anti"))
        pieces = F.create_map(*[x for m in masks for x in (F.lit(m), F.array(*map(F.lit, _split(m % (1 << BITS)))))])
        masks = sorted({s for m in masks for s in _split(m % (1 << BITS))})
        rows = settled(
            keyed.join(heavy, ["mask", "key"], "left_semi").select("fp", F.explode(pieces[F.col("mask")]).alias("mask")).distinct()
        )
        total += rows.count()
    grouped = done[0].select("mask", "key", "fp")
    for more in done[1:]:
        grouped = grouped.union(more.select("mask", "key", "fp"))
    tasks = max(shuffle_partitions(prints.sparkSession), -(-total // task_rows))
    return map_arrow(grouped.repartition(tasks, "mask", "key"), _join_groups, "a long, b long")


def _join_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
    if not parts:
        return
    mask, key, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
    fp = fp.view(np.uint64)
    order = np.lexsort((fp, key, mask))
    mask, key, fp = mask[order], key[order], fp[order]
    fresh = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
    label = trie_join(fp, fresh, np.r_[fresh[1:], len(fp)])
    moved = np.flatnonzero(label != np.arange(len(label)))
    if len(moved):
        yield pa.RecordBatch.from_arrays(
            [pa.array(fp[label[moved]].view(np.int64)), pa.array(fp[moved].view(np.int64))], ["a", "b"]
        )


def trie_join(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For each value the index of its component's first value.

    ``values`` holds groups end to end, each sorted and without repeats; a node of a group's trie is
    then a range, and its children are that range's two sides of where the next bit turns.
    """
    label = np.arange(len(values))
    many = ends - begins > 1
    begins, ends = begins[many], ends[many]
    stack = [(BITS - 1, begins, ends, begins, ends, np.zeros(len(begins), np.int64))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        bit, a0, a1, b0, b1, apart = stack.pop()
        if len(a0) > NODE_PAIRS:
            half = len(a0) // 2
            stack += [(bit, *(x[half:] for x in (a0, a1, b0, b1, apart))), (bit, *(x[:half] for x in (a0, a1, b0, b1, apart)))]
            continue
        # Nodes that are wholly one component already have nothing to add.
        turns = np.cumsum(np.r_[0, label[1:] != label[:-1]])
        whole = (turns[a0] == turns[a1 - 1]) & (turns[b0] == turns[b1 - 1]) & (label[a0] == label[b0])
        few = (a1 - a0) * (b1 - b0) <= LEAF_PAIRS
        leaf = few & ~whole
        if leaf.any():
            i, j = _pairs(a0[leaf], a1[leaf], b0[leaf], b1[leaf])
            near = np.bitwise_count(values[i] ^ values[j]) <= budget
            _unite(label, i[near], j[near])
        rest = ~few & ~whole
        if bit < 0 or not rest.any():
            continue
        a0, a1, b0, b1, apart = (x[rest] for x in (a0, a1, b0, b1, apart))
        if bit not in zeros:
            zeros[bit] = np.r_[0, np.cumsum((values >> np.uint64(bit)) & np.uint64(1) == 0)]
        before = zeros[bit]
        am, bm = a0 + before[a1] - before[a0], b0 + before[b1] - before[b0]
        same = a0 == b0
        unlike = (a0, am, bm, b1, apart + 1), tuple(x[~same] for x in (am, a1, b0, bm, apart + 1))
        alike = (a0, am, b0, bm, apart), (am, a1, bm, b1, apart)
        left, right, under, over, far = (np.concatenate(x) for x in zip(*alike, *unlike, strict=True))
        keep = (right > left) & (over > under) & (far <= budget) & ~((left == under) & (right - left < 2))
        stack.append((bit - 1, left[keep], right[keep], under[keep], over[keep], far[keep]))
    return label


def _pairs(a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of range pairs."""
    wide = b1 - b0
    sizes = (a1 - a0) * wide
    owner = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return a0[owner] + nth // wide[owner], b0[owner] + nth % wide[owner]


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join components of pairs in place; labels stay roots."""
    while True:
        x, y = label[i], label[j]
        open_ = x != y
        if not open_.any():
            return
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the smallest id reachable.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows are returned as
    often as they occur; rows without an id belong to components but never name one.
    """
    prints = settled(fingerprints(docs, text, doc_id))
    distinct = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    edges = links(distinct.select("fp"))
    roots = components(edges)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = settled(named.join(least, "root").select("fp", "component_id"))
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without all but the smallest id of each near-duplicate component.

    Of rows that repeat an id one stays; rows without an id stay.
    """
    seen = settled(near_duplicates(docs).filter("doc_id is not null"))
    ids = seen.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n"))
    ids = settled(ids)
    single = docs.join(ids.filter("component_id <> doc_id or n > 1").select("doc_id"), "doc_id", "left_anti")
    again = docs.join(ids.filter("component_id = doc_id and n > 1").select("doc_id"), "doc_id", "left_semi")
    return single.select(docs.columns).unionByName(again.select(docs.columns).dropDuplicates(["doc_id"]))


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
