"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on words preselected as telling of toxic text and one on
ordinary text. A window, which is a single word, is compressed with either; how many bytes the toxic
dictionary saves over the ordinary one is its gain. How many windows of a document reach each gain,
and what share of all they are, is calibrated to a probability on labelled rows that trained
neither dictionary.

A single short window compresses to nothing but its own overhead. So each is followed by the same
carrier, which both dictionaries begin with: the cost of a first match is then paid on both sides.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskloom.llm.common import fresh, map_arrow, table, with_field

#: Bounds of the labelled sample that the model is fitted on; rows are drawn by a hash of their id.
TOXIC_ROWS = 2000
ORDINARY_ROWS = 5000
#: The share of the sample that trains the dictionaries; the rest calibrates.
DICTIONARY_SHARE = 0.6
HELD_OUT = 2
CUT = 0.3

#: A character run of a word is telling if so many toxic documents have it, so many times as often.
RUN_LENGTHS = (5, 6, 7)
LEAST_DOCUMENTS = 4
LEAST_ODDS = 8.0
TOXIC_DICTIONARY = 4096
ORDINARY_DICTIONARY = 32768
LEVEL = 7
#: Windows of ordinary text that train its dictionary, and words of each.
ORDINARY_WINDOWS = 60_000
WINDOW_WORDS = 8
#: Gains are counted from 1 to this.
MOST_GAIN = 7
RIDGE = 1.0
KEPT_WORDS = 300_000

#: Bytes that do not occur in text.
CARRIER = bytes([1, 14, 2, 27, 3, 26, 4, 25, 5, 24, 6, 23, 7, 22, 8, 21, 15, 20, 16, 19, 17, 18, 28, 30])
_EDGES = b"\"'#*$%&|<>.,!?;:()[]{}"


def words(text: str) -> list[bytes]:
    """Words in lower case without the signs at their ends."""
    return [w.strip(_EDGES) for w in text.lower().encode("utf-8", "replace").split()]


@dataclass(frozen=True)
class Model:
    """Both dictionaries and the calibration; small, and sent to every task."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    bias: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        x = (features(counts) - np.array(self.centre)) / np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights) + self.bias, -30, 30)))


class Windows:
    """Gains of windows, kept per word."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.pair = [self._compressor(CARRIER + x) for x in (ordinary, toxic)]
        self.kept: dict[bytes, int] = {}

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False
        )

    def gain(self, word: bytes) -> int:
        window = b" " + word + b" " + CARRIER
        ordinary, toxic = (len(c.compress(window)) for c in self.pair)
        return min(max(ordinary - toxic, 0), MOST_GAIN)

    def counts(self, text: str) -> np.ndarray:
        """Windows of a text per gain from 0 to MOST_GAIN."""
        kept = self.kept
        out = np.zeros(MOST_GAIN + 1, np.int64)
        for word, n in Counter(words(text)).items():
            gain = kept.get(word)
            if gain is None:
                if len(kept) >= KEPT_WORDS:
                    kept.clear()
                gain = kept[word] = self.gain(word)
            out[gain] += n
        return out


@functools.lru_cache(maxsize=2)
def windows(toxic: bytes, ordinary: bytes) -> Windows:
    return Windows(toxic, ordinary)


def features(counts: np.ndarray) -> np.ndarray:
    """Per gain, how many windows reach it and their share of all windows."""
    reach = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1][:, 1:]
    total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    return np.hstack([np.log1p(reach), np.sqrt(reach / total)])


def telling_words(toxic: list[Counter], ordinary: list[Counter]) -> list[bytes]:
    """Words of toxic documents, as often as they occur, that have a telling run of characters."""
    often, seldom = Counter(), Counter()
    for docs, total in ((toxic, often), (ordinary, seldom)):
        for doc in docs:
            total.update(doc.keys())
    found = Counter()
    for word, n in often.items():
        for run in _runs(word):
            found[run] += n
    found = Counter({run: n for run, n in found.items() if n >= LEAST_DOCUMENTS})
    other = Counter()
    for word, n in seldom.items():
        for run in _runs(word):
            if run in found:
                other[run] += n
    a, b = len(toxic) + 1, len(ordinary) + 1
    telling = {r for r, n in found.items() if (n + 0.5) / a >= LEAST_ODDS * (other[r] + 0.5) / b}
    told = {word for word in often if not telling.isdisjoint(_runs(word))}
    return [word for doc in toxic for word, n in sorted(doc.items()) if word in told for _ in range(n)]


def _runs(word: bytes) -> set[bytes]:
    padded = b" " + word + b" "
    return {padded[i : i + n] for n in RUN_LENGTHS for i in range(len(padded) - n + 1)}


def train_dictionary(size: int, samples: list[bytes], cover: int) -> bytes:
    """What zstandard's trainer keeps of the samples; too few samples are kept as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=cover, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:] or b" "


def fit(texts: list[tuple[str, int]], odds: float) -> Model:
    """A model from (text, label) rows in random order; ``odds`` is toxic to ordinary among all labelled rows."""
    toxic = [t for t, y in texts if y]
    ordinary = [t for t, y in texts if not y]
    cut = [round(len(x) * DICTIONARY_SHARE) for x in (toxic, ordinary)]
    told = telling_words([Counter(words(t)) for t in toxic[: cut[0]]], [Counter(words(t)) for t in ordinary[: cut[1]]])
    groups = [b"".join(b" " + w + b" " for w in told[i : i + 6]) for i in range(0, len(told), 6)]
    plain: list[bytes] = []
    for text in ordinary[: cut[1]]:
        w = words(text)
        plain += [b" " + b" ".join(w[i : i + WINDOW_WORDS]) + b" " for i in range(0, len(w), WINDOW_WORDS)]
    every = max(1, len(plain) // ORDINARY_WINDOWS)
    of = train_dictionary(TOXIC_DICTIONARY, groups, 16), train_dictionary(ORDINARY_DICTIONARY, plain[::every], 32)
    gains = Windows(*of)
    kept = [(t, 1) for t in toxic[cut[0] :]] + [(t, 0) for t in ordinary[cut[1] :]]
    counts = np.array([gains.counts(t) for t, _ in kept]).reshape(-1, MOST_GAIN + 1)
    y = np.array([label for _, label in kept], float)
    x = features(counts)
    centre = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
    scale = x.std(axis=0) + 1e-6 if len(x) else np.ones(x.shape[1])
    if not 0 < y.sum() < len(y):  # one class or none: nothing to tell apart
        rate = odds / (1 + odds)
        bias = float(np.log(max(rate, 1e-9) / max(1 - rate, 1e-9)))
        return Model(*of, (0.0,) * x.shape[1], tuple(centre), tuple(scale), bias)
    weights, bias = _logistic((x - centre) / scale, y)
    bias += float(np.log(odds) - np.log(y.sum() / (len(y) - y.sum())))  # the sample has its own share of toxic rows
    return Model(*of, tuple(weights), tuple(centre), tuple(scale), bias)


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], RIDGE)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS) -> Model:
    """Fit on a bounded sample of labelled documents that are not held out.

    ``toxic_rows`` and ``ordinary_rows`` bound what reaches the driver. An id with several labels
    counts as toxic if one says so. Without labels every score is the share of toxic labels, 0 if none.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    tally = {r["toxic"]: r["n"] for r in known.groupBy(F.col("toxic") > 0).agg(F.count("*").alias("n")).toDF("toxic", "n").collect()}
    draw = F.xxhash64("doc_id")
    chosen = (
        known.filter("toxic > 0").orderBy(draw).limit(toxic_rows)
        .union(known.filter("toxic <= 0").orderBy(draw).limit(ordinary_rows))
    )
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = texts.withColumn("draw", draw).select("draw", "doc_id", "text", (F.col("toxic") > 0).cast("int").alias("y")).collect()
    rows.sort(key=lambda r: (r["draw"], r["doc_id"], r["text"]))
    toxic, ordinary = tally.get(True, 0), tally.get(False, 0)
    return fit([(r["text"], r["y"]) for r in rows], max(toxic, 1e-9) / max(ordinary, 1e-9 if toxic else 1.0))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1; null and empty texts score as texts without windows.

    The column is named ``score``, with underscores added until no column of ``docs`` has the name.
    """
    place, into = docs.columns.index(text), fresh(into, docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = windows(model.toxic, model.ordinary)
        for batch in batches:
            counts = np.array([gains.counts(t.as_py() or "") for t in batch.column(place)]).reshape(-1, MOST_GAIN + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(counts))], [*batch.schema.names, into])

    return map_arrow(docs, run, with_field(docs, into, DoubleType()))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is below the cut."""
    into = fresh("score", docs.columns)
    return score(docs, model, into=into).filter(F.col(into) < CUT).select(docs.columns)
