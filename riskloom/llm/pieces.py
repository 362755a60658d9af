"""SentencePiece encoding and decoding by suffix-array matching.

The words of a batch that were not met before are laid end to end, and a suffix array orders all
their suffixes as far as the longest piece reaches. Every piece of the model is searched in it by
bisection; its range of suffixes is where it occurs. These occurrences are edges between
characters. Sorted by position they are relaxed from left to right: an edge may follow the edge that
ends where it begins if the two pieces side by side encode to themselves, and exactly one edge
survives per end, because the model merges pairs by score. Which pieces may stand side by side is told from
the merges that make them, taken back one by one. Words go ahead together, a character at a time.
The result equals the model's own encoding; words are encoded apart because no piece spans two of them.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from riskloom.llm.common import blocks, fresh, map_arrow, table, with_field

MODEL = "piece_bpe_32k.model"
#: The mark that stands for a space.
MARK = "▁"
#: Words whose pieces a task keeps before it starts anew.
KEPT_WORDS = 600_000
#: Characters that are indexed at a time.
INDEXED = 250_000
#: Bytes of text that are encoded at a time.
PART_BYTES = 4_000_000
#: Characters that may precede a point inside pieces.
MOST_BEFORE = 16
#: Pairs of pieces whose verdict a task keeps, as many of either kind of store; the one of numbers has a power of two.
KEPT_PAIRS, PAIR_BITS = 300_000, 20
#: Words up to this length are relaxed side by side, longer ones and those with unknown characters one at a time.
LOCKSTEP = 48


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` codes, by doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    reach = 1
    while reach < depth:
        follow = np.zeros(len(rank), np.int64)
        follow[:-reach] = rank[reach:] + 1
        _, rank = np.unique(rank.astype(np.int64) * (len(rank) + 1) + follow, return_inverse=True)
        reach *= 2
    return np.argsort(rank, kind="stable")


def _bisect(codes: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, offset: int, wanted: np.ndarray) -> np.ndarray:
    """In each range of suffixes the first whose code at ``offset`` is at least ``wanted``."""
    low, high = low.copy(), high.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        less = codes[order[mid] + offset] < wanted[open_]
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]
    return low


def splitter(pieces: list[str]) -> re.Pattern:
    """Finds the words of a text: stretches that no piece goes beyond, with marks for spaces.

    A word begins at a run of marks, at a line feed, and at an ASCII point that follows a solid
    character. Points are what few characters precede inside pieces; those few are not solid.
    """
    if any(MARK in x.lstrip(MARK) or "\n" in x for x in pieces):
        return re.compile(r"(?s).+")
    before: dict[str, set[str]] = {}
    for piece in pieces:
        for a, b in zip(piece, piece[1:]):
            before.setdefault(b, set()).add(a)
    points = {c for c in map(chr, range(33, 127)) if not c.isalnum()}
    while wide := {p for p in points if len(before.get(p, set()) - points - {MARK}) > MOST_BEFORE}:
        points -= wide
    if not points:
        return re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
    listed = lambda chars: "".join(map(re.escape, sorted(chars)))
    loose = set().union(*(before.get(p, set()) for p in points)) | points | {MARK, "\n"}
    solid, point, other = f"[^{listed(loose)}]", f"[{listed(points)}]", f"[^{MARK}\n{listed(points)}]"
    return re.compile(f"{MARK}*(?:{point}|{other})(?:{other}+|(?<!{solid}){point})*|{MARK}+|\n")


class Pieces:
    """A BPE model's normal pieces with their scores, and what a task has encoded so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unknown = model.unk_id()
        n = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []  # what a piece decodes to
        self.byte_ids = [-1] * 256
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.bytes_of.append(b"")
            elif model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.longest = max(map(len, self.ids))
        names = list(self.ids)
        self.names = names
        self.piece_ids = np.array([self.ids[x] for x in names])
        self.piece_sizes = np.array([len(x) for x in names])
        self.codes = np.zeros((len(names), self.longest), np.int64)
        for row, name in enumerate(names):
            self.codes[row, : len(name)] = [ord(c) + 1 for c in name]
        self.splitter = splitter(names)
        self.pairs: dict[tuple[str, str], bool] = {}
        self._number_pairs()
        self.start()

    def _number_pairs(self) -> None:
        """Tables by row for telling pairs of pieces apart without merging them anew.

        ``rank`` is the order in which pieces come about, characters first. ``left`` and ``right`` are the two
        parts whose merge makes a piece, a character being its own. ``joined`` finds the rank of the piece that two rows make.
        """
        rows = {x: i for i, x in enumerate(self.names)}
        n = len(rows)
        by_score = sorted(range(n), key=lambda i: (len(self.names[i]) > 1, -self.scores[self.names[i]]))
        self.rank = np.empty(n, np.int64)
        self.rank[by_score] = np.arange(n)
        self.left, self.right = np.arange(n), np.arange(n)
        keys, ranks = [], []
        _, back, shared = np.unique([self.scores[x] for x in self.names], return_inverse=True, return_counts=True)
        self.plain = shared[back] == 1  # whether the tables tell all about a piece
        for name, i in rows.items():
            splits = [(rows[name[:k]], rows[name[k:]]) for k in range(1, len(name)) if name[:k] in rows and name[k:] in rows]
            keys += [a * n + b for a, b in splits]
            ranks += [self.rank[i]] * len(splits)
            if len(name) > 1:
                parts = self.merged(name, stop=2)
                made = self.merged(name) == [name] and len(parts) == 2 and all(x in rows for x in parts)
                if made:
                    self.left[i], self.right[i] = rows[parts[0]], rows[parts[1]]
                self.plain[i] &= made and self.rank[i] > max(self.rank[self.left[i]], self.rank[self.right[i]])
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys, self.pair_ranks = np.r_[np.array(keys, np.int64)[order], 1 << 62], np.r_[np.array(ranks, np.int64)[order], 0]
        self.verdict_keys, self.verdicts = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces of rows ``a`` and ``b`` stay as they are side by side, pair by pair.

        Merges are taken back from the last one on, always that of whichever side came about later. If what
        then meets in the middle makes a piece that comes before the merge taken back, or the same one further to the
        left, that would have happened instead.
        """
        n = len(self.names)
        out = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        limit = np.full(len(a), 1 << 62)
        while len(open_):
            key = a * n + b
            at = np.searchsorted(self.pair_keys, key)
            preempted = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit)
            out[open_[preempted]] = False
            first = self.rank[a] > self.rank[b]
            whole = np.where(first, self.left[a] == a, self.left[b] == b)  # the later one is a character: so are both
            going = ~preempted & ~whole
            a, b, first, open_ = a[going], b[going], first[going], open_[going]
            limit = np.where(first, self.rank[a], self.rank[b] + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return out

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """:meth:`stay` with what was found before."""
        key = a * len(self.names) + b
        slot = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        out = self.verdicts[slot]
        missed = np.flatnonzero(self.verdict_keys[slot] != key)
        if len(missed):
            _, one, back = np.unique(key[missed], return_index=True, return_inverse=True)
            one = missed[one]
            found = np.empty(len(one), bool)
            easy = self.plain[a[one]] & self.plain[b[one]]
            found[easy] = self.stay(a[one[easy]], b[one[easy]])
            for k in np.flatnonzero(~easy):
                found[k] = self.follows(self.names[a[one[k]]], self.names[b[one[k]]])
            self.verdict_keys[slot[one]], self.verdicts[slot[one]] = key[one], found
            out[missed] = found[back]
        return out

    def start(self) -> None:
        """Forget what was encoded."""
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.begins = np.zeros(1, np.int64)

    def merged(self, text: str, stop: int = 1) -> list[str]:
        """Pieces by merging the best-scored pair, leftmost among equals, until none, or only ``stop``, is left."""
        parts = list(text)
        scores = self.scores
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        """Whether ``a`` and ``b`` side by side stay as they are."""
        verdict = self.pairs.get((a, b))
        if verdict is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            verdict = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return verdict

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(start, row of the piece) of all occurrences of pieces in ``text``, by start and then length.

        ``text`` holds words with NUL after each, which no piece holds.
        """
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64) + 1
        codes = np.r_[codes, np.zeros(self.longest, np.int64)]
        n = len(codes)
        order = suffix_array(codes, self.longest)
        # Offsets past the end are never asked for: a range is empty before a piece runs over it.
        padded = np.r_[codes, np.zeros(self.longest, np.int64)]
        rows = np.flatnonzero(np.isin(self.codes[:, 0], np.unique(codes)))
        low, high = np.zeros(len(rows), np.int64), np.full(len(rows), n, np.int64)
        found_rows, found_low, found_high = [], [], []
        for k in range(self.longest):
            wanted = self.codes[rows, k]
            low, high = _bisect(padded, order, low, high, k, wanted), _bisect(padded, order, low, high, k, wanted + 1)
            some = high > low
            ended = some & (self.piece_sizes[rows] == k + 1)
            found_rows.append(rows[ended]), found_low.append(low[ended]), found_high.append(high[ended])
            going = some & ~ended
            rows, low, high = rows[going], low[going], high[going]
        piece, low, high = np.concatenate(found_rows), np.concatenate(found_low), np.concatenate(found_high)
        sizes = high - low
        owner = np.repeat(np.arange(len(piece)), sizes)
        start = order[low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        piece = piece[owner]
        by = np.argsort(start * (self.longest + 1) + self.piece_sizes[piece], kind="stable")
        return start[by], piece[by]

    def relax(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = "".join(w + "\0" for w in words)
        odd = set(text) - self.ids.keys() - {"\0"}
        hard = sizes > LOCKSTEP
        if odd:
            hard |= np.fromiter((not odd.isdisjoint(w) for w in words), bool, len(words))
        if hard.any():
            text = "".join(w + "\0" for w, h in zip(words, hard.tolist()) if not h)
        rows, counts = self._relax_together(text, sizes[~hard])
        failed = np.zeros(len(words), bool)
        failed[np.flatnonzero(~hard)[counts == 0]] = True
        hard |= failed
        ids = self.piece_ids[rows]
        if not hard.any():
            return ids, counts
        apart = iter(self.relax_apart([w for w, h in zip(words, hard.tolist()) if h]))
        easy = np.split(ids, np.cumsum(counts[counts > 0])[:-1]) if len(ids) else []
        together = iter(easy)
        out = [np.array(next(apart), np.int64) if h else next(together) for h in hard.tolist()]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _relax_together(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the pieces of all words end to end, and how many each has, 0 where no way was found.

        ``text`` holds the words with NUL after each. All words go ahead by one character at a time.
        """
        if not len(sizes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        starts, rows = self.edges(text)
        begins = np.cumsum(sizes + 1) - sizes - 1
        offset = starts - np.repeat(begins, sizes + 1)[starts]
        by = np.argsort(offset, kind="stable")
        starts, rows = starts[by], rows[by]
        ends = starts + self.piece_sizes[rows]
        bounds = np.searchsorted(offset[by], np.arange(int(sizes.max()) + 1))
        last = np.full(len(text) + 1, -1, np.int64)  # the piece that ends there
        first = bounds[1]
        last[ends[:first]] = rows[:first]
        for low, high in zip(bounds[1:], np.r_[bounds[2:], len(starts)]):
            before = last[starts[low:high]]
            reached = np.flatnonzero(before >= 0) + low
            reached = reached[self.may_follow(last[starts[reached]], rows[reached])]
            last[ends[reached]] = rows[reached]
        # Back along the surviving edges, all words at a time.
        at, found = begins + sizes, []
        going = np.arange(len(sizes))
        counts = np.zeros(len(sizes), np.int64)
        failed = np.zeros(len(sizes), bool)
        while len(going):
            piece = last[at[going]]
            failed[going[piece < 0]] = True
            going, piece = going[piece >= 0], piece[piece >= 0]
            found.append((going, piece))
            counts[going] += 1
            at[going] -= self.piece_sizes[piece]
            going = going[at[going] > begins[going]]
        counts[failed] = 0
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), np.int64)
        for nth, (going, piece) in enumerate(found):
            good = ~failed[going]
            out[ends[going[good]] - 1 - nth] = piece[good]
        return out, counts

    def relax_apart(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, edge by edge."""
        text = "".join(w + "\0" for w in words)
        starts, rows = self.edges(text)
        ends = starts + self.piece_sizes[rows]
        names = list(map(self.names.__getitem__, rows.tolist()))
        # Characters that are no piece stand for themselves.
        if odd := set(text) - self.ids.keys() - {"\0"}:
            places = [j for j, c in enumerate(text) if c in odd]
            names += [text[j] for j in places]
            starts, ends = np.r_[starts, places], np.r_[ends, np.array(places) + 1]
            order = np.argsort(starts, kind="stable")
            starts, ends, names = starts[order], ends[order], [names[k] for k in order.tolist()]
        last: list[str | None] = [None] * (len(text) + 1)  # the piece that ends there; "" where a word begins
        at = 0
        for w in words:
            last[at] = ""
            at += len(w) + 1
        verdict, follows = self.pairs.get, self.follows
        for i, j, piece in zip(starts.tolist(), ends.tolist(), names, strict=True):
            before = last[i]
            if before:
                ok = verdict((before, piece))
                if ok or ok is None and follows(before, piece):
                    last[j] = piece
            elif before is not None:
                last[j] = piece
        out, at = [], 0
        for w in words:
            out.append(self._path(text, last, at, at + len(w)))
            at += len(w) + 1
        return out

    def _path(self, text: str, last: list[str | None], begin: int, end: int) -> list[int]:
        parts: list[str] = []
        i = end
        while i > begin:
            piece = last[i]
            if not piece or len(piece) > i - begin:
                parts = self.merged(text[begin:end])[::-1]
                break
            parts.append(piece)
            i -= len(piece)
        ids: list[int] = []
        for piece in reversed(parts):
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            elif self.byte_ids[0] >= 0:
                ids += [self.byte_ids[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        return ids

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet, in blocks of bounded size."""
        block: list[str] = []
        size = 0
        for k, word in enumerate(words, 1):
            block.append(word)
            size += len(word) + 1
            if size >= INDEXED or k == len(words):
                ids, lengths = self.relax(block)
                first = len(self.begins) - 1
                self.known.update(zip(block, range(first, first + len(block))))
                self.begins = np.r_[self.begins, self.begins[-1] + np.cumsum(lengths)]
                self.flat = np.r_[self.flat, ids.astype(np.int32)]
                block, size = [], 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin and the last one's end."""
        if len(self.known) > KEPT_WORDS:
            self.start()
        chunks = [self.splitter.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(sorted(set(chain.from_iterable(chunks)) - self.known.keys()))
        numbers = np.fromiter(map(self.known.__getitem__, chain.from_iterable(chunks)), np.int64)
        begins = self.begins[numbers]
        sizes = self.begins[numbers + 1] - begins
        ends = np.r_[0, np.cumsum(sizes)]
        ids = self.flat[np.repeat(begins - ends[:-1], sizes) + np.arange(ends[-1])]
        return ids, ends[np.r_[0, np.cumsum([len(w) for w in chunks], dtype=np.int64)]]

    def decode(self, ids: list[int]) -> str:
        """The text of a row of ids: byte pieces joined to characters, the added first space taken off."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).removeprefix(b" ").decode("utf-8", "replace")


@functools.cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _parts(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where the column at ``place`` holds about PART_BYTES."""
    for batch in batches:
        column = batch.column(place)
        sizes = (pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length)(column)
        for a, b in blocks(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), PART_BYTES):
            yield batch.slice(a, b - a)


def encode(docs: DataFrame, text: str = "text", model: str | None = None, ids: str = "ids") -> DataFrame:
    """The documents with an array of piece ids, empty for a null or empty text.

    The column is named ``ids``, with underscores added until no column of ``docs`` has the name.
    ``model`` is the file's path on the workers.
    """
    return _coded(docs, text, model, fresh(ids, docs.columns), None)


def decode(docs: DataFrame, ids: str = "ids", model: str | None = None, text: str = "decoded") -> DataFrame:
    """The documents with the text that their ids stand for; null ids give null.

    The column is named ``decoded``, with underscores added until no column of ``docs`` has the name.
    """
    place, text = docs.columns.index(ids), fresh(text, docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model or default_model())
        for part in _parts(batches, place):
            texts = [None if x is None else coder.decode(x) for x in part.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, text])

    return map_arrow(docs, run, with_field(docs, text, StringType()))


def encode_and_decode(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """:func:`encode` and then :func:`decode` in one pass over the documents; column names follow the same rule."""
    ids = fresh("ids", docs.columns)
    return _coded(docs, text, model, ids, fresh("decoded", [*docs.columns, ids]))


def _coded(docs: DataFrame, text: str, model: str | None, ids: str, decoded: str | None) -> DataFrame:
    place = docs.columns.index(text)
    schema = with_field(docs, ids, ArrayType(IntegerType()))
    if decoded:
        schema = schema.add(decoded, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(model or default_model())
        for part in _parts(batches, place):
            flat, ends = coder.encode([t or "" for t in part.column(place).to_pylist()])
            columns = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))]
            if decoded:
                listed = flat.tolist()
                texts = [coder.decode(listed[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]
                columns.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], schema.names)

    return map_arrow(docs, run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256, round_trip) per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = encode_and_decode(docs)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
    )
