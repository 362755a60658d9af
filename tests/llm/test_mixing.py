import heapq
import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm import mixing


def sainte_lague(votes, seats):
    """Seat by seat from a heap of quotients; ties by name."""
    won = dict.fromkeys(votes, 0)
    heap = [(-v, k) for k, v in votes.items() if v]
    heapq.heapify(heap)
    for _ in range(seats if heap else 0):
        _, k = heapq.heappop(heap)
        won[k] += 1
        heapq.heappush(heap, (-votes[k] / (2 * won[k] + 1), k))
    return won


@pytest.mark.parametrize("seed", range(4))
def test_apportionment_equals_the_heap(spark, seed):
    rnd = random.Random(seed)
    rows, expected = [], {}
    for g in range(6):
        votes = {f"p{i:02d}": rnd.choice([0, 1, 1, 7, 50, rnd.randrange(1, 5000)]) for i in range(rnd.randrange(1, 25))}
        seats = rnd.choice([0, 1, 5, 100, 1000])
        rows += [(g, k, v, seats) for k, v in votes.items()]
        expected |= {(g, k): n for k, n in sainte_lague(votes, seats).items()}
    frame = spark.createDataFrame(rows, "g int, p string, v long, seats long")
    found = mixing.apportion(frame, ["g"], "seats", "v", [F.col("p")]).collect()
    assert {(r["g"], r["p"]): r["quota"] for r in found} == expected


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    open_, left, target = set(names), float(sum(sizes.values())), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing(spark, seed):
    rnd = random.Random(seed)
    sizes = {s: rnd.choice([0, 1, 10, 100, 5000]) for s in [None, *"abcdefghijk"[: 3 + 2 * seed]]}
    frame = spark.createDataFrame([*sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    expected = targets_by_hand(sizes)
    assert found.keys() == expected.keys()
    assert all(abs(found[s] - expected[s]) < 1e-6 * max(1, expected[s]) for s in found)


def test_mix(spark, sf_dir):
    rows = mixing.query(spark, sf_dir).collect()
    again = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(13), shard_docs=4_000).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in again)
    per = {}
    for r in again:
        assert 0 <= r["taken"] <= 3 * r["size"]
        per.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(t - n) <= 2 * mixing.BLOCK_WORDS for t, n in per.values())


def test_many_shards_keep_the_target(spark, sf_dir):
    rows = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("source", F.lit("one")), shard_docs=20).collect()
    assert sum(r["taken"] for r in rows) == pytest.approx(rows[0]["target"], abs=2 * mixing.BLOCK_WORDS)


def test_awkward(awkward, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == 10 and {r["size"] for r in rows if r["doc_id"] in (3, 4, 6)} == {0}
    assert mixing.mix(nothing).count() == 0
    taken = mixing.take(awkward)
    assert taken.columns == awkward.columns and taken.count() >= 1
    assert mixing.take(nothing).count() == 0
