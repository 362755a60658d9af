import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import fingerprint as fp

RANKS = np.arange(fp.LEVELS)[::-1].copy()


def features_by_hand(text: bytes) -> list[int]:
    """Places of the features of one text, straight from the definition."""
    def level(window):
        weight = sum(int(fp._WEIGHT[c]) for c in Counter(window).values())
        return (int(fp._WEIGHT[64]) - weight) * (fp.LEVELS - 1) // int(fp._WEIGHT[64])

    ranks = [int(RANKS[level(text[i : i + 64])]) for i in range(len(text) - 63)]
    score = Counter()
    for i in range(len(ranks) - 63):
        run = ranks[i : i + 64]
        score[i + run.index(min(run))] += 1
    return sorted(p for p, n in score.items() if n >= fp.POPULAR)


@given(st.lists(st.binary(min_size=0, max_size=400), min_size=1, max_size=4))
@settings(max_examples=25, deadline=None)
def test_features_equal_brute_force(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.r_[0, np.cumsum([len(t) for t in texts])]
    found = fp.feature_places(fp.entropy_levels(data), RANKS, at).tolist()
    expected = [int(at[i]) + p for i, t in enumerate(texts) for p in features_by_hand(t)]
    assert found == expected


def test_entropy_is_that_of_the_window():
    text = bytes(range(64)) + b"a" * 64
    levels = fp.entropy_levels(np.frombuffer(text, np.uint8))
    entropy = -sum(c / 64 * math.log2(c / 64) for c in Counter(text[20:84]).values()) / 6
    assert abs(levels[20] / (fp.LEVELS - 1) - entropy) < 2 / fp.LEVELS
    assert levels[0] == fp.LEVELS - 1 and levels[64] == 0


def test_likeness():
    rng = np.random.default_rng(1)
    a, b = (bytes(rng.integers(97, 123, 20_000, np.uint8)) for _ in range(2))
    pa, pb, half, none, tiny = fp.digests([a, b, a[:10_000] + b[:10_000], b"", b"short"], RANKS)
    assert len(pa) > 1
    assert fp.likeness(pa, pa) == 1 and fp.likeness(none, none) == 1 and fp.likeness(none, pa) == 0
    assert fp.likeness(pa, pb) < 0.05 and 0.25 < fp.likeness(pa, half) < 0.8
    assert fp.likeness(tiny, tiny) == 1 and len(none) == 0
    assert (fp.decode(fp.encode(pa)) == pa).all()


def expected_pairs(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for i, (k, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        h = len(t) // 2
        yield k, len(t), hashlib.sha256((t[: len(t) - h] + after[:h]).encode()).hexdigest()


@pytest.mark.parametrize("rows", [None, [(4, "only one text here")], []])
def test_edited_texts(spark, awkward, rows):
    docs = awkward.select("doc_id", "text") if rows is None else spark.createDataFrame(rows, "doc_id long, text string")
    ranks = fp.entropy_ranks(docs)
    assert sorted(ranks.tolist()) == list(range(fp.LEVELS))
    found = fp.compare_edited(docs, ranks).collect()
    expected = list(expected_pairs([tuple(r) for r in docs.collect()]))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == Counter(expected)
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))


def test_order_over_many_slices(spark):
    docs = spark.range(3000).selectExpr("id * id as doc_id", "repeat(cast(id as string), 20) as text").repartition(7)
    found = fp.compare_edited(docs, RANKS).select("doc_id", "n_chars", "edited_sha256").collect()
    assert Counter(map(tuple, found)) == Counter(expected_pairs([tuple(r) for r in docs.collect()]))


def test_equal_texts_and_other_columns(awkward, nothing):
    found = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(awkward, RANKS).collect()}
    assert found[3] == found[4] == "" and len(found) == 9
    assert fp.fingerprints(nothing, RANKS).count() == 0
