import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import simhash
from riskloom.llm.components import components


def by_hand(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values):
    """Smallest index that each value reaches over links of four bits or fewer."""
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if bin(int(a) ^ int(values[j])).count("1") <= 4:
                x, y = sorted((label[i], label[j]))
                label = [x if k == y else k for k in label]
    return label


@given(st.lists(st.text(alphabet="aB é\t\n", max_size=40), max_size=6))
@settings(max_examples=50, deadline=None)
def test_fingerprints_equal_brute_force(texts):
    assert simhash.simhashes(t.encode() for t in texts).tolist() == [by_hand(t) for t in texts]


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(str(i * i) for i in range(700))
    monkeypatch.setattr(simhash, "HASHES", 50)
    assert simhash.simhashes([text.encode(), b"x", b""]).tolist() == [by_hand(text), by_hand("x"), 0]


@pytest.mark.parametrize("leaf", [1, 16])
@pytest.mark.parametrize("pairs", [3, 200_000])
def test_trie_join_equals_all_pairs(monkeypatch, leaf, pairs):
    monkeypatch.setattr(simhash, "LEAF_PAIRS", leaf)
    monkeypatch.setattr(simhash, "NODE_PAIRS", pairs)
    rng = np.random.default_rng(leaf + pairs)
    seeds = rng.integers(0, 1 << 63, 12, np.uint64)
    noisy = [s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, False))) for s in seeds for n in (0, 2, 3, 4, 6, 9)]
    values = np.unique(np.array(noisy, np.uint64))
    label = simhash.trie_join(values, np.array([0]), np.array([len(values)]))
    assert label.tolist() == classes(values)


def test_heavy_groups_are_split_not_cut(spark):
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    dense = {base ^ sum(1 << int(b) for b in rng.choice(20, 6, False)) for _ in range(150)}
    values = sorted(dense | {int(x) for x in rng.integers(0, 1 << 62, 50)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(frame, group_rows=10, task_rows=50)).collect()}
    got = [roots.get(v, v) for v in values]
    expected = classes(np.array(values, np.uint64))
    assert [got.index(g) for g in got] == expected


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, k) for k in range(1001, 1080)] + [(7, 7), (200, 201), (201, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = {}
    for node, root in found.items():
        groups.setdefault(root, set()).add(node)
    assert sorted(map(len, groups.values())) == [2, 61, 80]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(awkward, nothing):
    found = simhash.near_duplicates(awkward).collect()
    ids = {r["doc_id"]: r["component_id"] for r in found}
    assert len(found) == 10 and ids[1] == ids[2] == 1 and ids[3] == ids[4] == ids[6] == 3 and ids[5] == 5
    assert {r["fp"] for r in found if r["doc_id"] in (3, 4, 6)} == {0}
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3, 5, 7, 8]


def test_query_equals_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    values = np.array([by_hand(r["text"]) for r in docs], np.uint64)
    label = classes(values)
    expected = {r["doc_id"]: (f"{int(v):016x}", docs[k]["doc_id"]) for r, v, k in zip(docs, values, label)}
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.query(spark, sf_dir).collect()}
    assert found == expected
