"""Mix sources to target weights by Sainte-Lague apportionment of equal blocks.

The documents of a shard lie end to end in a seeded order, as one stream of words that is cut into
blocks of equal length. Sources get whole blocks by highest quotients of their targets, shards of a
source likewise by their sizes. A shard takes its quota as full passes over the stream and one more
run of blocks that begins at a seeded block, so nearly all documents are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, settled, table, word_count

SEED = 7
#: Words of a block; a source misses its target by about half of one.
BLOCK_WORDS = 64
#: Documents of a shard on average; the running total over one is the largest ordered group.
SHARD_DOCS = 4_000
#: A source is repeated so often at most.
MOST_PASSES = 3
#: Weights of the sources in turn.
WEIGHTS = (1, 2, 3)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """(source, docs, source_size, target): words each source should give; one row per source.

    Sources by code point with null last weigh ``weights`` in turn and share the sum of all sizes; no
    target is above ``most`` times its source's size, and what is above goes to the rest by weight.
    That ends where every source has the least of its limit and a common level times its weight;
    the level follows from the sources in order of limit by weight. The two windows without a
    partition hold a row per source, never documents.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1) % len(weights) + 1
    weighed = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")))
    order = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    below = order.rowsBetween(W.unboundedPreceding, -1)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        weighed.withColumn("limit", most * F.col("source_size"))
        .withColumn("total", F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn("full", F.coalesce(F.sum("limit").over(below), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
        # The first source whose limit is above the level sets it for itself and all after it; of
        # sources with equal limits by weight the first has the highest level.
        .withColumn("open", F.col("limit") >= F.col("level") * F.col("weight"))
        .withColumn("common", F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), (-F.col("level")).alias("level")))).over(every))
    )
    target = F.least(F.col("limit").cast("double"), -F.col("common")["level"] * F.col("weight"))
    return levels.select("source", "docs", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def apportion(parties: DataFrame, group: list[str], seats: str, votes: str, tie: list[Column]) -> DataFrame:
    """Append ``quota``: each group's ``seats`` given to its rows by highest ``votes / (2 k + 1)``.

    Rounding at a divisor that is surely too high, and at one surely too low, bounds every quota from
    below and above; only the quotients between are ranked, about two for a row. Exact, without
    going through the seats. Ties go by ``tie``. Rows without votes get none.
    """
    within = W.partitionBy(*group)
    share = F.col(votes) / F.col("_votes")
    few, many = F.col(seats) - F.col("_rows") / 2 - 1, F.col(seats) + F.col("_rows") / 2 + 1
    bounded = (
        parties.withColumn("_votes", F.sum(votes).over(within))
        .withColumn("_rows", F.sum((F.col(votes) > 0).cast("int")).over(within))
        .withColumn("_low", F.when(F.col(votes) > 0, F.greatest(F.lit(0), F.floor(share * few + 0.5))).otherwise(0).cast("long"))
        .withColumn("_high", F.when(F.col(votes) > 0, F.greatest(F.lit(0), F.floor(share * many + 0.5))).otherwise(0).cast("long"))
        .withColumn("_left", F.col(seats) - F.sum("_low").over(within))
    )
    quotients = bounded.withColumn("_k", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1))))
    ranked = quotients.withColumn(
        "_rank", F.row_number().over(within.orderBy(F.desc_nulls_last(F.col(votes) / (2 * F.col("_k") + 1)), *tie, "_k"))
    )
    won = F.sum((F.col("_k").isNotNull() & (F.col("_rank") <= F.col("_left"))).cast("long")).over(
        W.partitionBy(*group, *tie)
    )
    return (
        ranked.withColumn("quota", F.col("_low") + won)
        .filter(F.col("_k").isNull() | (F.col("_k") == F.col("_low")))
        .select(*parties.columns, "quota")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_docs: int = SHARD_DOCS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per document row.

    ``size`` is the number of words, 0 for a null text, and ``taken`` how many of them the mix takes,
    at most three times the size. The order and the first block depend on ids and ``seed`` alone.
    """
    sizes = settled(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    goals = settled(targets(sizes))
    # The target in whole blocks; the sum is rounded once and shared out by highest quotients.
    goals = goals.withColumn("_seats", F.round(F.sum("target").over(W.partitionBy(F.lit(1))) / block_words).cast("long"))
    by_source = [F.col("source")]
    seats = settled(
        apportion(goals.withColumn("_all", F.lit(1)), ["_all"], "_seats", "target", by_source)
        .withColumnRenamed("quota", "blocks")
        .withColumn("shards", F.ceil(F.col("docs") / shard_docs))
        .select("source", "source_size", "target", "blocks", "shards")
    )
    draw = F.xxhash64(F.lit(seed), F.col("doc_id"))
    same = F.col("s.source").eqNullSafe(F.col("g.source"))
    placed = sizes.alias("s").join(F.broadcast(seats.alias("g")) if seats.count() <= BROADCAST_SOURCES else seats.alias("g"), same)
    placed = placed.select("s.doc_id", "s.source", "s.size", "g.source_size", "g.target", "g.blocks", "g.shards").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("doc_id")), F.col("shards"))
    )
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("blocks").alias("blocks"))
    quotas = settled(apportion(shards, ["source"], "blocks", "words", [F.col("source"), F.col("shard")]).select("source", "shard", "words", "quota"))
    stream = W.partitionBy("source", "shard").orderBy(draw, "doc_id", "size")
    along = placed.withColumn("end", F.sum("size").over(stream.rowsBetween(W.unboundedPreceding, 0)))
    joined = along.alias("d").join(
        quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")) & (F.col("d.shard") == F.col("q.shard"))
    )
    cuts = joined.select("d.doc_id", "d.source", "d.size", "d.source_size", "d.target", "d.end", "q.words", "q.quota", "d.shard")
    return cuts.withColumn("taken", _taken(block_words, seed)).select("doc_id", "source", "size", "source_size", "target", "taken")


#: Source tables up to this many rows are sent to every task; larger ones are joined by shuffle.
BROADCAST_SOURCES = 10_000


def _taken(block_words: int, seed: int) -> Column:
    """Words taken of a document that ends at ``end`` in a stream of ``words`` words."""
    words, quota = F.col("words"), F.col("quota")
    blocks = F.greatest(F.lit(1), F.round(words / block_words)).cast("long")
    passes, run = F.floor(quota / blocks), quota % blocks
    first = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("source"), F.col("shard")), blocks)
    capped = F.when(passes >= MOST_PASSES, 0).otherwise(run)

    def edge(block: Column) -> Column:
        return F.floor(block * words / blocks)

    def before(x: Column) -> Column:
        """Words of the extra run among the first x of the stream; the run may go round its end."""
        inside = F.least(x, edge(F.least(first + capped, blocks))) - F.least(x, edge(first))
        round_ = F.least(x, edge(F.greatest(first + capped - blocks, F.lit(0))))
        return inside + round_

    start = F.col("end") - F.col("size")
    return (F.least(passes, F.lit(MOST_PASSES)) * F.col("size") + before(F.col("end")) - before(start)).cast("long")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def take(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, rounded to whole copies, at most three.

    Rows that repeat an id are taken alike. Documents without words are not part of a mix of words.
    """
    share = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    n, key, nth = (fresh(x, docs.columns) for x in ("_copies", "_key", "_copy"))
    copies = mix(docs).groupBy("doc_id").agg(F.max(share).cast("int").alias(n)).filter(F.col(n) > 0)
    kept = docs.join(copies.withColumnRenamed("doc_id", key), F.col("doc_id").eqNullSafe(F.col(key)))
    return kept.withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(n)))).select(docs.columns)
