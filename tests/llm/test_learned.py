"""Toxicity, quality rules and the pipeline on rows that taught nothing, and against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm import mixing, pieces, quality_rules, secret_scan, simhash, toxicity
from riskloom.llm.common import table

RUDE = ("blargh", "gruntle", "snarfle", "fizzwort", "moggle")


def corpus(n=1500, seed=1):
    """(doc_id, text, toxic): invented prose; one in five has rude words, about two in a hundred."""
    rnd = random.Random(seed)
    stock = ["".join(rnd.choice(["an", "the", "or", "ti", "es", "lo", "ra", "mi", "un"]) for _ in range(rnd.randrange(1, 5))) for _ in range(400)]
    for i in range(n):
        words = [rnd.choice(stock) for _ in range(rnd.randrange(20, 200))]
        toxic = int(rnd.random() < 0.2)
        if toxic:
            for _ in range(max(1, len(words) // 50)):
                words.insert(rnd.randrange(len(words)), rnd.choice(RUDE))
        yield i, " ".join(words).capitalize() + ".", toxic


@pytest.fixture(scope="module")
def model():
    taught = [(t, y) for i, t, y in corpus() if zlib.crc32(str(i).encode()) % 4 != 2]
    return toxicity.fit(taught, sum(y for _, y in taught) / sum(1 - y for _, y in taught))


def test_held_out_accuracy(model):
    rest = [(t, y) for i, t, y in corpus() if zlib.crc32(str(i).encode()) % 4 == 2]
    gains = toxicity.Windows(model.toxic, model.ordinary)
    scores = model.scores(np.array([gains.counts(t) for t, _ in rest]))
    y = np.array([y for _, y in rest])
    found = scores >= toxicity.CUT
    assert found[y == 1].mean() > 0.9 and y[found].mean() > 0.9


def test_gain_is_a_difference_of_lengths(model):
    gains = toxicity.Windows(model.toxic, model.ordinary)
    assert gains.gain(b"blargh") > gains.gain(b"theorti") and gains.gain(b"") == 0
    assert gains.counts("Blargh blargh, anor") .sum() == 3


def test_scores_of_documents(awkward, nothing, model):
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.drop_toxic(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == 10
    assert toxicity.drop_toxic(nothing, model).count() == 0


def test_without_labels_or_with_one_class(spark, awkward):
    for rows in ([], [(1, 0), (2, None), (None, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        scored = toxicity.score(awkward, toxicity.train(awkward, labels)).collect()
        assert all(r["score"] < toxicity.CUT or not rows for r in scored)


def test_held_out_rows(spark):
    ids = [r["id"] for r in spark.range(400).filter(toxicity.held_out("id")).collect()]
    assert ids == [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]


def test_toxicity_query(spark, sf_dir):
    rows = {r["doc_id"]: r for r in toxicity.query(spark, sf_dir).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    assert len(rows) == table(spark, sf_dir, "documents").count()
    assert all(r["predicted"] == (r["score"] >= 0.3) and r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert labels


# --- quality ---


def statistics_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {p + k for places in at.values() if len(places) > 1 for p in places for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_brute_force(spark, awkward, nothing):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choice(["a ", "b ", "a b a ", "\n", "\t", "é ", "x#\n", "| "]) for _ in range(rnd.randrange(60)))) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward.select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = sorted((r["doc_id"] or -1, *(r[n] for n in names)) for r in quality_rules.statistics(frame).collect())
    assert found == sorted((r["doc_id"] or -1, *statistics_by_hand(r["text"])) for r in frame.collect())
    assert quality_rules.statistics(nothing).count() == 0


def test_rules_are_found_in_order(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(1200):
        n, symbols, dups = 100 + rnd.randrange(400), rnd.choice([0, 0, 0, 80]), rnd.choice([0, 0, 0, 9])
        rows.append((i, n, 5 * n, symbols, dups, 0, symbols > 50 or dups > 5))
    names = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, bad boolean"
    frame = spark.createDataFrame(rows, names)
    rules = quality_rules.learn(frame)
    judged = frame.withColumn("by", quality_rules.verdict(rules))
    assert 2 <= len(rules) <= 4 and judged.filter(F.col("bad") != F.col("by").isNotNull()).isEmpty()
    assert quality_rules.learn(frame.filter("not bad")) == [] and quality_rules.learn(frame.limit(0)) == []


def test_quality_query(spark, sf_dir):
    rows = quality_rules.query(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", rows._jdf.queryExecution().executedPlan().toString())
    found = {r["doc_id"]: r for r in rows.collect()}
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf_dir, "labels").collect()}
    assert all(not r["kept"] for r in found.values() if r["base_failed"])
    good = [found[i]["kept"] for i, q in labels.items() if q == 1 and not found[i]["base_failed"]]
    assert sum(good) >= 0.95 * len(good)


# --- pipeline ---


def test_pipeline_equals_its_parts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    gains = toxicity.Windows(model.toxic, model.ordinary)
    clean = [i for i, r in rows.items() if model.scores(gains.counts(r["text"] or "")[None])[0] < toxicity.CUT]
    prints = dict(zip(clean, simhash.simhashes((rows[i]["text"] or "").encode() for i in clean).tolist()))
    label = {i: i for i in clean}
    for a in clean:
        for b in clean:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4 and label[a] != label[b]:
                x, y = sorted((label[a], label[b]))
                label = {i: x if k == y else k for i, k in label.items()}
    kept = [i for i in clean if label[i] == i]
    scanner = secret_scan.Scanner()
    masked = {}
    for i in kept:
        text = rows[i]["text"] or ""
        data = np.frombuffer(text.encode(), np.uint8)
        spans = scanner.spans([text], data, np.array([0, len(data)]))[0]
        masked[i] = secret_scan.mask(text, [(a, b) for a, _, b in spans], "[SECRET]")
    frame = spark.createDataFrame([(i, masked[i], rows[i]["source"]) for i in kept], "doc_id long, text string, source string")
    copies = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) if r["size"] else 0 for r in mixing.mix(frame).collect()}
    coder = pieces.Pieces(pieces.default_model())
    expected = sorted((i, masked[i], coder.encode([masked[i]])[0].tolist()) for i in kept for _ in range(copies[i]))
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == [*docs.columns, "ids"]
    assert sorted((r["doc_id"], r["text"], r["ids"]) for r in found.collect()) == expected


def test_stages_on_awkward_rows(spark, awkward, nothing, sf_dir):
    for docs in (awkward, nothing):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, sf_dir)
            assert out.columns[: len(docs.columns)] == docs.columns and (k == 4 or len(out.columns) == len(docs.columns))
            out.count()
