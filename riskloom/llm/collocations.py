"""Phrase collocations by set-oriented mining (SETM) over persisted occurrence relations.

An occurrence is a row (piece, position, phrase). The relation of one length is written once,
bucketed by piece and sorted by position, and merge-joined with itself: an occurrence and the next
position's occurrence overlap in all but their outer words, so together they are an occurrence one
word longer. Grouped counts keep the frequent phrases, and a semi-join with those trims the relation
before it is extended again. Buckets and join keys agree, so extending shuffles nothing; what is
shuffled is the texts, once, before they are taken apart, and counts that tasks have added up before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import discard, kept, table
from riskloom.session import shuffle_partitions, work_dir

LEAST = 100
LONGEST = 5
TOP = 2000
#: A phrase goes when a longer one holds it and has at least this share of its occurrences, in percent.
ABSORBED = 100
#: Frequent phrases up to this number are sent to all executors (some 100 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Occurrences that a bucket holds at most, in the mean.
BUCKET_ROWS = 20_000_000

# Upper-case letters and what they become; the marks and line ends that end a piece.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENDS = "[.,;:!?\\x0A-\\x0D]"


def tokens(text: Column) -> Column:
    """The words of a text in order, as they are spelled, with a line feed standing between two pieces."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), ENDS, " \n ")
    return F.array_remove(F.split(F.replace(spaced, F.lit("\t"), F.lit(" ")), " "), "")


def lowered(word: Column) -> Column:
    return F.translate(word, UPPER, LOWER)


def numbered_texts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, row, text): ``row`` tells texts apart, also those that repeat or have no id.

    It follows the order in which a table's files are read, which stays the same when a task is repeated.
    """
    return docs.select(
        F.coalesce(F.col(lang), F.lit("und")).alias("lang"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text).alias("text"),
    )


def words_of(texts: DataFrame) -> DataFrame:
    """(lang, row, pos, word) of numbered texts: adjacent words of a piece have adjacent positions, others never.

    Words are as they are spelled: a spelling is lowered once where it is counted, not wherever it occurs.
    """
    return texts.select("lang", "row", F.posexplode(tokens(F.col("text"))).alias("pos", "word")).filter(F.col("word") != "\n")


def word_occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    return words_of(numbered_texts(docs, text, lang))


@contextmanager
def _buckets_serve_joins(spark: SparkSession) -> Iterator[None]:
    """Let tables bucketed by one of several join keys be joined as they lie, in the order they have if it is known."""
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Occurrences:
    """A relation (row, pos, id), written in buckets by row and sorted, until it is dropped."""

    def __init__(self, spark: SparkSession, rows: DataFrame, buckets: int):
        self.spark, self.name = spark, f"occurrences_{uuid.uuid4().hex}"
        self.path = work_dir(spark, "occurrences")
        # A side that lies in these buckets already is not shuffled again.
        laid = rows.repartition(buckets, "row").sortWithinPartitions("row", "pos")
        writer = laid.write.bucketBy(buckets, "row").sortBy("row", "pos")
        writer.format("parquet").option("path", self.path).saveAsTable(self.name)
        self.rows = spark.table(self.name)

    def neighbours(self) -> DataFrame:
        """(row, pos, left, right): the occurrence at each position and the one at the next."""
        right = self.rows.select("row", (F.col("pos") - 1).alias("pos"), F.col("id").alias("right"))
        left = self.rows.select("row", "pos", F.col("id").alias("left"))
        return left.join(right.hint("merge"), ["row", "pos"])

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")
        discard(self.spark, self.path)


def _fitting(frequent: DataFrame) -> DataFrame:
    """Marked for broadcast only if its counted rows are few."""
    return F.broadcast(frequent) if frequent.count() <= BROADCAST_ROWS else frequent


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) with all word occurrences, and per length a table of the phrases that occur often enough.

    A phrase's row has ``id``, ``lang``, ``words`` and ``f``; ``heads`` and ``tails`` are the counts of
    its first and last 1, 2, ... words, itself last; from two words on, ``left`` and ``right`` are the ids of
    the phrases without its last and without its first word.
    """
    spark = docs.sparkSession
    texts = numbered_texts(docs, text, lang)
    spelled = words_of(texts).groupBy("lang", "word").agg(F.count("*").alias("f"))
    spellings = kept(spelled.withColumn("lower", lowered(F.col("word"))), "spellings")
    counts = spellings.groupBy("lang", F.col("lower").alias("word")).agg(F.sum("f").alias("f"))
    totals = kept(spellings.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    single = F.array(F.col("f"))
    first = counts.filter(F.col("f") >= least).select(
        F.monotonically_increasing_id().alias("id"), "lang", F.array("word").alias("words"), "f", single.alias("heads"), single.alias("tails")
    )
    found = [kept(first, "phrases-1")]
    total = found[0].agg(F.coalesce(F.sum("f"), F.lit(0)).alias("n")).head()["n"]
    buckets = max(shuffle_partitions(spark), -(-total // BUCKET_ROWS))
    often = found[0].select("lang", F.col("words")[0].alias("lower"), "id")
    known = spellings.join(_fitting(often), ["lang", "lower"]).select("lang", "word", "id")
    with _buckets_serve_joins(spark):
        # Texts are dealt to the buckets whole: a row per text is moved, not one per word.
        dealt = words_of(texts.repartition(buckets, "row"))
        held = Occurrences(spark, dealt.join(_fitting(known), ["lang", "word"]).select("row", "pos", "id"), buckets)
        for size in range(2, longest + 1):
            pairs = held.neighbours()
            often = kept(pairs.groupBy("left", "right").agg(F.count("*").alias("f")).filter(F.col("f") >= least), "pairs")
            found.append(kept(_extended(often, found[-1]), f"phrases-{size}"))
            if size < longest:
                ids = _fitting(found[-1].select("left", "right", "id"))
                longer = Occurrences(spark, pairs.join(ids, ["left", "right"]).select("row", "pos", "id"), buckets)
                held.drop()
                held = longer
        held.drop()
    return totals, found


def _extended(often: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases one word longer, from the pairs of shorter ones that overlap in them."""
    left = shorter.select(F.col("id").alias("left"), "lang", "words", "heads")
    right = shorter.select(F.col("id").alias("right"), F.element_at("words", -1).alias("last"), "tails")
    return often.join(left, "left").join(right, "right").select(
        F.monotonically_increasing_id().alias("id"),
        "lang",
        F.concat("words", F.array("last")).alias("words"),
        "f",
        F.concat("heads", F.array("f")).alias("heads"),
        F.concat("tails", F.array("f")).alias("tails"),
        "left",
        "right",
    )


def score(a: Column, n: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """``floor(1000 * a * n / (l * r))`` in whole numbers of up to 38 digits; a division, not a double."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a * 1000) * wide(n), wide(l) * wide(r))


def _least_cut(size: int) -> Column:
    """Of the ways to cut a phrase in two, the one with the smallest score, the shortest first part among equals."""
    cuts = []
    for k in range(1, size):
        head, tail = F.col("heads")[k - 1], F.col("tails")[size - k - 1]
        cuts.append(F.struct(score(F.col("f"), F.col("n"), head, tail).alias("score"), F.lit(k).alias("k"), head.alias("l"), tail.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    absorbed: int = ABSORBED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best-scored phrases of two words and more.

    Null and empty texts have no words; a null language counts as ``und``; repeated rows count as often
    as they occur; other columns are not looked at. An empty table, or one without a frequent phrase,
    gives no row. Equal scores go by more occurrences, then by the phrase's bytes.
    """
    totals, found = frequent_phrases(docs, text, lang, least, longest)
    sizes: list[DataFrame] = []
    for i in range(1, longest):
        phrases = found[i]
        if i + 1 < longest:
            # A phrase inside a longer one is the first or the last part of one a single word longer,
            # which occurs at least as often as any longer still.
            longer = found[i + 1]
            ends = longer.select(F.col("left").alias("id"), "f").union(longer.select(F.col("right").alias("id"), "f"))
            most = ends.groupBy("id").agg(F.max("f").alias("most"))
            phrases = phrases.join(most, "id", "left").filter(
                F.coalesce(100 * F.col("most") < absorbed * F.col("f"), F.lit(True))
            )
        cut = phrases.join(F.broadcast(totals), "lang").withColumn("cut", _least_cut(i + 1))  # a row per language
        sizes.append(cut.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"))
    scored = sizes[0]
    for more in sizes[1:]:
        scored = scored.union(more)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def sql() -> str:
    """The same for DuckDB: phrases as slices of each piece's list of words, counted in one go."""
    letters = f"'{UPPER}' || chr(9), '{LOWER} '"
    cuts = " UNION ALL ".join(
        f"""SELECT c.lang, c.phrase, c.size, c.a, h.a AS l, t.a AS r, {k} AS k
        FROM often c JOIN often h ON h.lang = c.lang AND h.words = c.words[1:{k}]
        JOIN often t ON t.lang = c.lang AND t.words = c.words[{k + 1}:] WHERE c.size > {k}"""
        for k in range(1, LONGEST)
    )
    return f"""
    WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {letters}) AS text FROM documents),
    pieces AS (
        SELECT lang, list_filter(string_split(piece, ' '), lambda w: w <> '') AS words
        FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts)
    ),
    totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
    starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
    phrases AS (
        SELECT lang, words[i:i + size - 1] AS words, size
        FROM starts, (SELECT unnest(range(1, {LONGEST + 1})) AS size) WHERE i + size - 1 <= len(words)
    ),
    often AS (
        SELECT lang, words, size, array_to_string(words, ' ') AS phrase, count(*) AS a
        FROM phrases GROUP BY lang, words, size HAVING count(*) >= {LEAST}
    ),
    cuts AS ({cuts}),
    scored AS (
        SELECT cuts.*, n, CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score
        FROM cuts JOIN totals USING (lang)
    ),
    chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    free AS (
        SELECT * FROM chosen c WHERE NOT EXISTS (
            SELECT 1 FROM often o WHERE o.lang = c.lang AND o.size > c.size AND 100 * o.a >= {ABSORBED} * c.a
            AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')
        )
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {TOP}
    """
