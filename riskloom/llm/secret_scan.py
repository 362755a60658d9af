"""Secret scans with a trigram index in front of the rules.

From each rule's regular expression a Boolean query over trigrams is derived that every match obeys.
A block of documents gets an inverted index from the trigrams of these queries to its documents;
posting lists are intersected and united as the query says, and only the candidates meet the
regular expression. A rule from which no trigram can be derived reads every document. The index is
of ASCII-folded bytes, so it never hides a match; what a scan returns equals that of all rules over
all texts.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as codes
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import blocks, map_arrow, table, text_bytes


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of a match or of one of its groups."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False


# A private key's first or last line; what lies between them; and, without a last line, the header
# fields and base64 that follow, of which only the last lines may be short. Lines may be quoted,
# indented, or joined by escapes. Repeats are possessive, so time is in proportion to the text.
_KEY = "-----{} (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----"
_TO_END = r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+" + _KEY.format("END")
_BREAK = r"(?:\s|\\[nrt]|[\"'+,>#*|])*?"
_LINE_END = r"(?=[\"',;]*(?:\\[nr]|[ \t\r]*(?:\n|\Z)))"
_TO_LAST = (
    rf"(?:{_BREAK}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\n\\]*+)*+"
    rf"(?:(?:{_BREAK}[A-Za-z0-9+/]{{24,}}+={{0,2}})++(?:{_BREAK}[A-Za-z0-9+/]++(?:={{1,2}}|{_LINE_END}))?+(?:{_BREAK}=[A-Za-z0-9+/]{{4}}{_LINE_END})?+)?+"
)

# The kinds and patterns of secrets, in the order in which equal spans are listed.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
    Rule("private", _KEY.format("BEGIN") + rf"(?:{_TO_END}|{_TO_LAST})"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("login", r"[a-z][a-z0-9+]*://[^\s:/@]+:[^\s:/@]+@[A-Za-z0-9.-]+", 12),
)
BASE = ("assign", "access", "hex")

#: A query is True (no condition), or an "or" of "and"s of folded trigrams.
Query = frozenset[frozenset[bytes]] | bool
#: Sets of literal strings are followed up to this size.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """The trigrams that any match of ``pattern`` has, in ASCII lower case; True if nothing is sure."""
    strings, query = _required(parser.parse(pattern, re.ASCII))
    return _also(query, _of_strings(strings))


def _fold(text: str) -> bytes:
    return text.encode().lower()


def _of_strings(strings: frozenset[bytes] | None) -> Query:
    """That one of the strings occurs."""
    if not strings or any(len(s) < 3 for s in strings):
        return True
    return frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _also(a: Query, b: Query) -> Query:
    if a is True or b is True:
        return b if a is True else a
    return frozenset(x | y for x in a for y in b)


def _either(queries: list[Query]) -> Query:
    return True if any(q is True for q in queries) else frozenset().union(*queries)


def _required(nodes) -> tuple[frozenset[bytes] | None, Query]:
    """The exact strings that ``nodes`` may match, or None if unknown, and a query for what else it needs."""
    strings, query = frozenset([b""]), True
    whole = True  # strings covers everything so far
    for code, value in nodes:
        more, need = _required_of(code, value)
        query = _also(query, need)
        if more is not None and len(strings) * len(more) <= MOST_STRINGS:
            strings = frozenset(a + b for a in strings for b in more)
            continue
        # An unknown part ends a run of literals: the run is asked for, and a new one begins.
        whole = False
        query = _also(query, _of_strings(strings))
        strings = more if more is not None else frozenset([b""])
    if whole:
        return strings, query
    return None, _also(query, _of_strings(strings))


def _required_of(code, value) -> tuple[frozenset[bytes] | None, Query]:
    if code is codes.LITERAL:
        return frozenset([_fold(chr(value))]), True
    if code is codes.IN:
        chars: set[bytes] = set()
        for kind, x in value:
            if kind is codes.LITERAL:
                chars.add(_fold(chr(x)))
            elif kind is codes.RANGE and x[1] - x[0] < MOST_STRINGS:
                chars |= {_fold(chr(c)) for c in range(x[0], x[1] + 1)}
            else:
                return None, True
        return (frozenset(chars), True) if len(chars) <= 8 else (None, True)
    if code is codes.SUBPATTERN:
        return _required(value[-1])
    if code is codes.BRANCH:
        parts = [_required(x) for x in value[1]]
        if all(s is not None for s, _ in parts):
            return frozenset().union(*(s for s, _ in parts)), _either([q for _, q in parts])
        return None, _either([_also(q, _of_strings(s)) for s, q in parts])
    if code in (codes.MAX_REPEAT, codes.MIN_REPEAT):
        low, high, inner = value
        strings, query = _required(inner)
        if (low, high) == (0, 1) and strings is not None and query is True:
            return strings | {b""}, True
        if low == high == 1:
            return strings, query
        return None, (_also(query, _of_strings(strings)) if low else True)
    if code is codes.AT:
        return frozenset([b""]), True
    return None, True


class Scanner:
    """Compiled rules with their queries; ``spans`` finds what they match in a block of documents."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.compiled = [re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.fold else 0)) for r in rules]
        grams = sorted({g for q in self.queries if q is not True for part in q for g in part})
        self.number = {g: i for i, g in enumerate(grams)}
        self.slot = np.zeros(1 << 24, np.uint16)  # 1 + the trigram's number
        for gram, i in self.number.items():
            self.slot[gram[0] << 16 | gram[1] << 8 | gram[2]] = i + 1

    def postings(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """For each trigram the ascending documents that hold it."""
        if len(data) < 3:
            return [np.empty(0, np.int64)] * len(self.number)
        low = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
        wide = low.astype(np.uint32)
        found = self.slot[wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]]
        places = np.flatnonzero(found)
        owner = np.searchsorted(at, places, "right") - 1
        inside = places + 3 <= at[owner + 1]
        pairs = np.unique(found[places[inside]].astype(np.int64) << 32 | owner[inside])
        cuts = np.searchsorted(pairs, np.arange(1, len(self.number) + 2, dtype=np.int64) << 32)
        docs = pairs & 0xFFFFFFFF
        return [docs[cuts[i] : cuts[i + 1]] for i in range(len(self.number))]

    def candidates(self, query: Query, postings: list[np.ndarray], docs: int) -> np.ndarray:
        if query is True:
            return np.arange(docs)
        alternatives = []
        for part in query:
            lists = sorted((postings[self.number[g]] for g in part), key=len)
            alternatives.append(functools.reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists))
        return functools.reduce(np.union1d, alternatives)

    def spans(self, texts: list[str], data: np.ndarray, at: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text its (start, rule, end) in code points, sorted."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings(data, at)
        for k, (rule, query, pattern) in enumerate(zip(self.rules, self.queries, self.compiled, strict=True)):
            for i in self.candidates(query, postings, len(texts)).tolist():
                for m in pattern.finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out[i].append((m.start(), k, m.end()))
        return [sorted(x) for x in out]


@functools.cache
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _scan_blocks(batch: pa.RecordBatch, rules: tuple[Rule, ...]) -> Iterator[tuple[int, list[str], list]]:
    """(first row, texts, spans) of the text column's blocks."""
    column = batch.column(batch.schema.get_field_index("text"))
    data, at = text_bytes(column)
    for a, b in blocks(np.diff(at)):
        texts = [x or "" for x in column.slice(a, b - a).to_pylist()]
        yield a, texts, scanner(rules).spans(texts, data[at[a] : at[b]], at[a : b + 1] - at[a])


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) per document row; spans is array<struct<kind, start, end>> by start, then kind as listed.

    Positions are code points, end exclusive. Null and empty texts have no spans. Matches of one rule
    never overlap; those of several may.
    """
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = [
                [{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans]
                for _, _, block in _scan_blocks(batch, rules)
                for spans in block
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(kind))], ["doc_id", "spans"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_arrow(chosen, run, "doc_id long, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret, or chain of overlapping secrets, replaced by ``mark``.

    ``n_chars``, if there is such a column, follows the text. All else stays, nulls included.
    """
    place, n = docs.columns.index(text), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(place)
            texts = column.to_pylist()
            sized = batch.column(n).to_pylist() if n is not None else None
            for first, block, spans in _scan_blocks(pa.RecordBatch.from_arrays([column], ["text"]), rules):
                for i, (was, found) in enumerate(zip(block, spans, strict=True), first):
                    if found:
                        texts[i] = mask(was, [(a, b) for a, _, b in found], mark)
                        if sized is not None:
                            sized[i] = len(texts[i])
            columns = list(batch.columns)
            columns[place] = pa.array(texts, column.type)
            if n is not None:
                columns[n] = pa.array(sized, batch.column(n).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, run, docs.schema)


def mask(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with every chain of overlapping spans, given by start, replaced by ``mark``."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end = spans[i]
        while i < len(spans) and spans[i][0] < end or spans[i : i + 1] == [(start, end)]:
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def query(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *map(count, BASE), F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans")
    )
