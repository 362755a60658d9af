import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import oracle
from riskloom.llm import collocations
from riskloom.session import shuffle_partitions


def by_hand(rows, least, longest, top, absorbed=100):
    """All results from (lang, text) rows, with Python's integers."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    often = {key: a for key, a in counts.items() if a >= least}
    out = []
    for (lang, words), a in often.items():
        if len(words) < 2:
            continue
        inside = lambda long: any(long[i : i + len(words)] == words for i in range(len(long) - len(words) + 1))  # noqa: B023, E731
        if any(g == lang and len(w) > len(words) and 100 * f >= absorbed * a and inside(w) for (g, w), f in often.items()):
            continue
        n = totals[lang]
        cuts = [(1000 * a * n // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], n, score))
    ranked = []
    for lang in totals:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(x[0], i, *x[1:]) for i, x in enumerate(mine[:top], 1)]
    return sorted(ranked)


ROWS = [
    ("en", "The cat sat. the CAT sat on the mat, the cat sat on the mat"),
    ("en", "a b a b a b a b\na b\tc  c c c c c c"),
    ("en", "a b a b a b a b\na b\tc  c c c c c c"),
    (None, "x y z x y z\rx y z"),
    ("und", "x y z"),
    ("de", "ÉtÉ ÉtÉ été ÉtÉ; und und und"),
    ("de", None),
    ("fr", ""),
    ("fr", " \t .,; \x0b"),
    ("es", "\U0001f600 ￿ \U0001f600 ￿ \U0001f600 ￿"),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(lang, text, i, "x") for i, (lang, text) in enumerate(ROWS)], "lang string, text string, id long, word string")


@pytest.mark.parametrize("least,top,absorbed", [(2, 100, 100), (3, 2, 100), (2, 100, 60), (50, 9, 100)])
def test_equals_brute_force(rows, least, top, absorbed):
    found = collocations.collocations(rows, least=least, top=top, absorbed=absorbed).collect()
    assert sorted(map(tuple, found)) == by_hand(ROWS, least, 5, top, absorbed)


def test_equals_brute_force_by_shuffled_joins(rows, monkeypatch):
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(collocations, "BUCKET_ROWS", 7)
    found = collocations.collocations(rows, least=2, longest=4).collect()
    assert sorted(map(tuple, found)) == by_hand(ROWS, 2, 4, 2000)


def test_awkward_and_empty(awkward, nothing):
    listed = [(r["lang"], r["text"]) for r in awkward.collect()]
    found = collocations.collocations(awkward).collect()
    assert sorted(map(tuple, found)) == by_hand(listed, 100, 5, 2000) != []
    assert collocations.collocations(nothing).collect() == []


def test_scores_beyond_64_bits(spark):
    cases = [(9_000_000_000_000, 9_000_000_000_000_000, 10_000_000_000_001, 9_999_999_999_999), (100, 10**15, 100, 100), (7, 1, 3, 1000)]
    frame = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = [tuple(r) for r in frame.select("a", "n", "l", "r", collocations.score(*map(F.col, "anlr"))).collect()]
    assert got == [(a, n, l, r, 1000 * a * n // (l * r)) for a, n, l, r in cases]


def test_extending_shuffles_nothing(spark, rows):
    words = collocations.word_occurrences(rows).select("row", "pos", F.hash("word").alias("id"))
    with collocations._buckets_serve_joins(spark):
        held = collocations.Occurrences(spark, words, shuffle_partitions(spark))
        plan = held.neighbours()._jdf.queryExecution().executedPlan().toString()
        held.drop()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_texts_are_moved_not_words(spark, rows):
    """Words are taken out of texts that lie in the buckets already, and an occurrence is sorted for one side of a join only."""
    buckets = shuffle_partitions(spark) + 3
    words = collocations.words_of(collocations.numbered_texts(rows).repartition(buckets, "row"))
    laid = words.select("row", "pos", F.hash("word").alias("id")).repartition(buckets, "row")
    lines = laid._jdf.queryExecution().executedPlan().toString().splitlines()
    taken, moved = (next(i for i, line in enumerate(lines) if name in line) for name in ("Generate", "Exchange"))
    assert taken < moved and sum("Exchange" in line for line in lines) == 1  # the plan is printed from its end
    with collocations._buckets_serve_joins(spark):
        held = collocations.Occurrences(spark, laid, buckets)
        plan = held.neighbours()._jdf.queryExecution().executedPlan().toString()
        held.drop()
    assert plan.count("Sort [") == 1


def test_spellings_of_a_word_are_one(spark):
    texts = [("en", "Ab aB\tAB;ab\x0bAb É é É"), ("de", "É Ab"), (None, "aB ab"), ("en", "$1 \\ $1 \\ $1")]
    frame = spark.createDataFrame(texts, "lang string, text string")
    found = collocations.collocations(frame, least=1).collect()
    assert sorted(map(tuple, found)) == by_hand(texts, 1, 5, 2000)


def test_matches_sql(spark, sf_dir):
    assert oracle.compare(collocations.query(spark, sf_dir), oracle.connect(sf_dir), collocations.sql()) is None
