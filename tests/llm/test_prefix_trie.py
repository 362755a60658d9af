import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import oracle
from riskloom.llm import prefix_trie


def by_hand(rows):
    """All nodes from (conv_id, turn, role, text) rows, with whole prefixes as keys; turns must not tie."""
    said = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            said[conv].append((role or "", text or ""))
    rebuilt = {}
    for c, own in said.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(said.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        childless = [p for p in below if not any(q[:-1] == p and len(q) == len(p) + 1 for q in members)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
            sum(len(q) == len(path) + 1 and q[:-1] == path for q in members), len(childless), saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, prefix_trie.prefix_trie(frame).collect()), key=str)


ROWS = [
    # Conversations that share their base's head, an absent base (11, 12), null turns, roles and texts.
    *[(c, t, "user" if t % 2 else "system", f"say {t if t < 3 else c % 3} é") for c in range(10) for t in range(c % 7 + 1)],
    *[(c, t, "user", "hello") for c in (11, 12, 203, 70_000, 70_001, 140_000) for t in range(12)],
    (20, None, None, None), (20, 5, "user", ""), (20, 9, None, "last"), (21, 3, "user", "x" * 100_000),
    (-5, 0, "user", "below"), (-7, 1, "user", "zero"), (None, 0, "user", "nobody"), (30, 2, "ab", "c"), (31, 2, "a", "bc"),
    *[(c, t, "user", f"long {t % 7}") for c in (40, 41) for t in range(300)],
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "conv_id long, turn long, role string, text string, value int")


def test_powers(spark):
    exponents = [0, 1, 8, 255, 256, 70_000, (1 << 32) - 1]
    frame = spark.createDataFrame([(e,) for e in exponents], "e long")
    for base, prime in zip(prefix_trie.BASES, prefix_trie.PRIMES):
        assert [r[0] for r in frame.select(prefix_trie.power(base, F.col("e"), prime)).collect()] == [pow(base, e, prime) for e in exponents]


def test_equals_brute_force(rows):
    assert found(rows) == by_hand(ROWS)


def test_equals_brute_force_in_slices_with_clashing_hashes_and_a_second_seed(rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SLICE_BITS", 1)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 1)
    monkeypatch.setattr(prefix_trie, "content_hash", lambda role, text: (F.length(text) % 4).cast("long"))
    real, seeds = prefix_trie.rebuilt_prefixes, []

    def poor_at_first(turns, seed):
        seeds.append(seed)
        made = real(turns, seed)
        return made if len(seeds) > 1 else made.withColumn("value", F.col("value") % 3)

    monkeypatch.setattr(prefix_trie, "rebuilt_prefixes", poor_at_first)
    assert found(rows) == by_hand(ROWS)
    assert len(seeds) == 2


def test_ties_repeats_and_empty(spark, rows):
    assert found(rows.limit(0)) == []
    tied = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z"), (2, 0, "b", "x"), (2, 0, "a", "y")]
    make = lambda r: spark.createDataFrame(r, "conv_id long, turn long, role string, text string")
    once = found(make(tied))
    assert once == found(make(tied[::-1]).repartition(3))
    assert sum(r[3] for r in once if r[1] == 0) == 2


def test_matches_sql(spark, sf_dir):
    assert oracle.compare(prefix_trie.query(spark, sf_dir), oracle.connect(sf_dir), prefix_trie.sql()) is None
