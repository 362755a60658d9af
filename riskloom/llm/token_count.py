"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary is a JSON file of lower-case word pieces with word ends. A word starts as one symbol
per byte; a heap holds the adjacent pairs that merge, lowest rank first and leftmost among equals;
each merge unlinks a symbol and may push two new pairs. A word counts its symbols less its merges;
no ids are made. Words repeat, so a task keeps the counts of those it has met.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Words whose counts a task keeps before it starts anew.
KEPT_WORDS = 500_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Counting:
    """Counts tokens as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ending = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        self.vocabulary = set(model["vocab"])
        self.ranks = {
            tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])
        }
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]))
        self.kept: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Tokens of one word."""
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += self.ending
        # A symbol outside the vocabulary has no token and joins nothing.
        symbols = [s for s in symbols if s in self.vocabulary]
        if len(symbols) < 2:
            return len(symbols)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        ranks = self.ranks
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or symbols[i] != pair[0] or symbols[j] != pair[1]:
                continue  # one of the two has merged since
            merges += 1
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (p := (symbols[a], symbols[b])) in ranks:
                    heapq.heappush(heap, (ranks[p], a, p))
        return len(symbols) - merges

    def text(self, text: str) -> int:
        """Tokens of a whole text; the strings of special tokens count as one each."""
        pieces = self.special.split(text)
        total = len(pieces) - 1
        kept = self.kept
        for piece in pieces:
            for word, times in Counter(self.words.findall(self.normal(piece))).items():
                n = kept.get(word)
                if n is None:
                    if len(kept) >= KEPT_WORDS:
                        kept.clear()
                    n = kept[word] = self.word(word)
                total += n * times
        return total

    @staticmethod
    def normal(text: str) -> str:
        """Composed, in lower case letter by letter; white space never reaches a word."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "\u03a3" in text:  # str.lower would turn it to another letter at a word's end
                text = text.replace("\u03a3", "\u03c3")
        return text.lower()


@functools.cache
def counting(path: str) -> Counting:
    return Counting(path)


def token_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per document row; a null or empty text has none of either.

    ``vocabulary`` is the file's path on the workers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counting(vocabulary or default_vocabulary())
        for batch in batches:
            tokens = [count.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), size.alias("n_bytes"))
    return map_arrow(chosen, run, "doc_id long, n_bytes long, n_tokens long")


def query(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
