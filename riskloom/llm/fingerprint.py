"""Improbable-feature digests of documents.

Every window of 64 bytes has an entropy; how rare that entropy is over all windows of the corpus
gives its rank. In each run of 64 neighbouring windows the rarest, leftmost among equals, scores; a
window that scores often enough is a feature of its text. Features go into a chain of Bloom filters
of bounded load, and two digests are compared by how far the bits of their filters overlap beyond
chance.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, map_arrow, table, text_bytes
from riskloom.session import shuffle_partitions

#: Bytes of a window, and windows of which the rarest scores.
WINDOW = 64
#: Scores from which a window is a feature.
POPULAR = 16
#: Levels that entropies are rounded to.
LEVELS = 1024
#: Slices of the documents in order of id; a slice is streamed, so more are needed for parallel work only.
MOST_SLICES = 4000
#: A Bloom filter: its bits, bits set by a feature, and features until the next one begins.
FILTER_BITS = 2048
HASHES = 5
FILTER_FEATURES = 160
#: Overlap up to chance plus this share of what is possible beyond it counts as none.
MARGIN = 0.1

_SCALE = 1 << 16
#: c log2 c for c bytes of a kind in a window, in whole steps so that running sums stay exact.
_WEIGHT = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int64)
_BYTES = FILTER_BITS // 8


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level of the entropy of each window of ``data``; windows may cross texts."""
    n = len(data)
    if n < WINDOW:
        return np.empty(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for k in range(1, WINDOW):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    # The weight changes when a byte comes in (equal ones before it) and when one goes (after it).
    step = _WEIGHT[1:] - _WEIGHT[:-1]
    come, go = step[before], step[after]
    total = np.cumsum(come)[WINDOW - 1 :]
    total[1:] -= np.cumsum(go[: n - WINDOW])
    top = _WEIGHT[WINDOW]
    return (top - total) * (LEVELS - 1) // top


def _whole(at: np.ndarray, length: int) -> np.ndarray:
    """Mask over positions at which ``length`` bytes lie in one text."""
    mark = np.zeros(at[-1] + 1, np.int32)
    ends = np.maximum(at[:-1], at[1:] - length + 1)
    np.add.at(mark, at[:-1], 1)
    np.add.at(mark, ends, -1)
    return np.cumsum(mark)[:-1] > 0


def feature_places(levels: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the features of texts begin, ascending."""
    run = 2 * WINDOW - 1  # bytes that 64 neighbouring windows cover
    if len(levels) < WINDOW:
        return np.empty(0, np.int64)
    lowest = ranks[levels].astype(np.int64) << 40 | np.arange(len(levels))
    reach = 1
    while reach < WINDOW:
        lowest = np.minimum(lowest[:-reach], lowest[reach:])
        reach *= 2
    rarest = lowest[_whole(at, run)[: len(lowest)]] & ((1 << 40) - 1)
    return np.flatnonzero(np.bincount(rarest, minlength=0) >= POPULAR)


def feature_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the window at each place."""
    lanes = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places].copy().view("<u8")
    mixed = np.full(len(places), 0x9E3779B97F4A7C15, np.uint64)
    for lane in lanes.T:
        mixed = (mixed ^ lane) * np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xC4CEB9FE1A85EC53)
    return mixed ^ (mixed >> np.uint64(29))


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """For each text its Bloom filters, one per row.

    A feature counts once per text. A text too short or too even for features has its whole self as
    the only one; an empty text has no filter.
    """
    out: list[np.ndarray] = []
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    for a, b in blocks(lengths):
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        at = np.r_[0, np.cumsum(lengths[a:b])]
        places = feature_places(entropy_levels(data), ranks, at)
        hashes = feature_hashes(data, places) if len(places) else np.empty(0, np.uint64)
        cuts = np.searchsorted(places, at)
        for i in range(b - a):
            found = hashes[cuts[i] : cuts[i + 1]]
            if not len(found) and texts[a + i]:
                whole = hashlib.sha256(texts[a + i]).digest()[:8]
                found = np.frombuffer(whole, "<u8")
            out.append(_filters(found))
    return out


def _filters(hashes: np.ndarray) -> np.ndarray:
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    chain = np.zeros((-(-len(hashes) // FILTER_FEATURES), FILTER_BITS), np.uint8)
    which = np.arange(len(hashes)) // FILTER_FEATURES
    for k in range(HASHES):
        chain[which, (hashes >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = 1
    return np.packbits(chain, axis=1)


def encode(filters: np.ndarray) -> str:
    return base64.b64encode(filters.tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, _BYTES)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the mean, over the filters of the shorter digest, of the best overlap in the longer one.

    Equal digests have 1, an empty and a non-empty one 0. Overlap is the number of common bits,
    normalised so that what chance gives is 0 and all bits of the lesser filter are 1.
    """
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(a) > len(b) or len(a) == len(b) and a.tobytes() > b.tobytes():
        a, b = b, a
    if not len(a):
        return 0.0
    ones_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(a))
    for i, row in enumerate(a):
        ones = int(np.bitwise_count(row).sum(dtype=np.int64))
        common = np.bitwise_count(b & row).sum(axis=1, dtype=np.int64)
        most = np.minimum(ones, ones_b)
        chance = ones * ones_b / FILTER_BITS
        floor = chance + MARGIN * (most - chance)
        best[i] = ((common - floor) / np.maximum(most - floor, 1e-9)).clip(0, 1).max()
    return float(best.mean())


def entropy_ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy level, the rarest over all windows of all texts first.

    One count per level and task is all that is gathered. Levels that never occur come first; ties
    go by level.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS, np.int64)
        for batch in batches:
            data, at = text_bytes(batch.column(0))
            for a, b in blocks(np.diff(at)):
                levels = entropy_levels(data[at[a] : at[b]])
                whole = _whole(at[a : b + 1] - at[a], WINDOW)[: len(levels)]
                counts += np.bincount(levels[whole], minlength=LEVELS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["level", "n"])

    counts = map_arrow(docs.select(F.col(text).alias("text")), run, "level long, n long")
    total = np.zeros(LEVELS, np.int64)
    for row in counts.groupBy("level").agg(F.sum("n").alias("n")).collect():  # LEVELS rows at most
        total[row["level"]] = row["n"]
    ranks = np.empty(LEVELS, np.int64)
    ranks[np.lexsort((np.arange(LEVELS), total))] = np.arange(LEVELS)
    return ranks


def fingerprints(docs: DataFrame, ranks: np.ndarray, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, fingerprint) per document row; null is empty, and equal texts have equal fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            found = digests([data[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], ranks)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(encode, found), pa.string())], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(chosen, run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame, slices_per_task: int = 4) -> DataFrame:
    """(slice, ahead, doc_id, text), each slice whole in one partition and sorted, ids ascending over slices.

    The first document of the next slice comes after each slice once more, with ``ahead`` set; after
    the last slice that is the first of all. Slices are cut at quantiles of the ids, so they are even
    wherever the ids lie. Texts move once. Null ids come first; equal ids follow their texts.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    steps = min(parts * slices_per_task, MOST_SLICES)
    place = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    ids = docs.select("doc_id").withColumn("place", place)
    cuts = ids.approxQuantile("place", [i / steps for i in range(1, steps)], 1 / (4 * steps))
    inner = sorted({c for c in cuts if np.isfinite(c)}) or [0.0]
    slicer = Bucketizer(inputCol="place", outputCol="slice", splits=[float("-inf"), *inner, float("inf")], handleInvalid="keep")
    sliced = lambda df: slicer.transform(df).withColumn("slice", F.col("slice").cast("int")).drop("place")
    # A row per slice: the number of slices follows the session's tasks, not the rows.
    firsts = sorted((r["slice"], r["doc_id"]) for r in sliced(ids).groupBy("slice").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("none")).select("slice", F.when(~F.col("none"), F.col("doc_id")).alias("doc_id")).collect())
    heads = spark.createDataFrame(
        [(s, d, firsts[i - 1][0]) for i, (s, d) in enumerate(firsts)], "slice int, head long, also int"
    )
    rows = sliced(docs.select("doc_id", "text").withColumn("place", place)).join(F.broadcast(heads), "slice")
    is_head = F.col("doc_id").eqNullSafe(F.col("head"))
    here = F.struct(F.col("slice"), F.lit(False).alias("ahead"))
    there = F.struct(F.col("also").alias("slice"), F.lit(True).alias("ahead"))
    copied = rows.withColumn("to", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))))
    return (
        copied.select("to.slice", "to.ahead", "doc_id", "text")
        .repartition(parts, "slice")
        .sortWithinPartitions("slice", "ahead", F.asc_nulls_first("doc_id"), "text")
    )


EDITED_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edited(docs: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, compared; columns as in EDITED_SCHEMA.

    In an edited text the last half of the code points, rounded down, is replaced by as many from the
    start of the next document. A single document is its own next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # slice, id, text and digest of the last document: its successor is still to come
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for a, b in blocks(np.array([len(r[3] or "") for r in rows])):
                part = [(s, ahead, i, t or "") for s, ahead, i, t in rows[a:b]]
                own = digests([r[3].encode() for r in part], ranks)
                pairs = []
                for (s, ahead, i, t), print_ in zip(part, own, strict=True):
                    if held and held[0] == s and held[4] is not True:
                        pairs.append((held[1:4], t, print_))
                    held = (s, i, t, print_, ahead)
                if pairs:
                    yield _compared(pairs, ranks)

    return map_arrow(in_order(docs), run, EDITED_SCHEMA)


def _compared(pairs: list, ranks: np.ndarray) -> pa.RecordBatch:
    edited = [(t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode() for (_, t, _), nxt, _ in pairs]
    prints = digests(edited, ranks)
    columns = [
        pa.array([i for (i, _, _), _, _ in pairs], pa.int64()),
        pa.array([len(t) for (_, t, _), _, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        pa.array([encode(own) for (_, _, own), _, _ in pairs], pa.string()),
        pa.array([encode(p) for p in prints], pa.string()),
        pa.array([likeness(own, p) for ((_, _, own), _, _), p in zip(pairs, prints, strict=True)], pa.float64()),
        pa.array([likeness(own, after) for (_, _, own), _, after in pairs], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in EDITED_SCHEMA.split(", ")])


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return compare_edited(docs, entropy_ranks(docs))
