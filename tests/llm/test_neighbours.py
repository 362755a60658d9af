import numpy as np
import pytest

from riskloom.llm import neighbours

EVERY = "true"
SCHEMA = "vec_id long, embedding array<float>, id long, vec string, shard string"


def make(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y") for i, v in rows], SCHEMA)


def by_hand(rows, queries, nearest=10):
    """All exact answers, in double precision on float components."""
    plain = {(i, tuple(np.float32(v).tolist())) for i, v in rows if i is not None and v and None not in v and np.all(np.isfinite(v)) and any(v)}
    out = {}
    for q in queries:
        mine = [v for i, v in plain if i == q]
        if mine:
            best = []
            for i, v in plain:
                if i != q:
                    best += [(float(np.sqrt(sum((a - b) ** 2 for a, b in zip(m, v)))), i) for m in mine if len(m) == len(v)]
            out[q] = sorted(best)[:nearest]
    return out


def found(frame, queries=EVERY, **more):
    out = {}
    for r in sorted(neighbours.nearest_neighbours(frame, queries, **more).collect()):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["score"], r["vec_id"]))
    return out


def test_small_tables_are_exact_with_copies_ties_nulls_and_lengths(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 3).tolist()) for i in range(60)]
    rows += [(100 + i, [1.0, 1.0, 1.0]) for i in range(40)] + [(100, [1.0, 1.0, 1.0])] * 2
    rows += [(200, None), (201, []), (202, [0.0, 0.0, 0.0]), (203, [1.0, None, 2.0]), (204, [1.0, float("nan"), 2.0])]
    rows += [(205, [1.0, float("inf"), 2.0]), (None, [5.0, 5.0, 5.0]), (206, [1.0, -0.0, 2.0]), (207, [1.0, 0.0, 2.0])]
    rows += [(300 + i, [float(i), 1.0]) for i in range(5)] + [(400, [7.0])]
    got, expected = found(make(spark, rows)), by_hand(rows, range(-1, 500))
    assert {q: v for q, v in expected.items() if v} == {q: [(pytest.approx(s), i) for s, i in v] for q, v in got.items()}


def test_an_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 3.0]), (2, [1.0, 0.5]), (3, [0.0, 2.0])]
    got = found(make(spark, rows), "vec_id > 1", nearest=2)
    assert {i for _, i in got[2]} == {1, 3} and {i for _, i in got[3]} == {1, 2}
    assert got[2][0] == (0.5, 1) and got[3][0] == (1.0, 1)


def test_empty(spark):
    assert found(make(spark, [(1, None)])) == {}
    assert found(make(spark, [(1, [1.0])])) == {}


@pytest.mark.parametrize("kind", ["clusters", "even", "line"])
def test_recall_where_groups_must_be_joined(spark, monkeypatch, kind):
    """Groups and shards so small that lists come from descent and search; recall against all pairs."""
    monkeypatch.setattr(neighbours, "LEAF", 60)
    monkeypatch.setattr(neighbours, "SHARD_NODES", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 17)
    monkeypatch.setattr(neighbours, "HELD_PAIRS", 20_000)
    rng = np.random.default_rng(5)
    n = 1500
    if kind == "clusters":
        x = rng.standard_normal((n, 16)) * 0.01 + rng.standard_normal((5, 16))[rng.integers(0, 5, n)]
        x[: n // 3] = x[0]  # a vector that a third of all rows have
    elif kind == "even":
        x = rng.standard_normal((n, 8)) * 1e6
    else:
        x = np.c_[np.linspace(0, 1, n) ** 2 * 1e-3 + 1, np.ones(n)]
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    got = found(make(spark, rows).drop("id"), "vec_id % 25 = 0")
    expected = by_hand(rows, range(0, n, 25))
    assert got.keys() == expected.keys() and all(len(v) == 10 for v in got.values())
    hits = sum(s <= expected[q][-1][0] for q, v in got.items() for s, _ in v)
    assert hits >= 0.97 * 10 * len(got)


def test_query_recall(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {}
    for r in neighbours.query(spark, sf_dir).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = by_hand(rows, [i for i, _ in rows if i % 100 == 0])
    hits = sum(i in got[q] for q, v in expected.items() for _, i in v)
    assert hits >= 0.9 * sum(map(len, expected.values()))
