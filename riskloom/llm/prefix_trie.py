"""A trie of conversation prefixes from composable fingerprints.

A run of turns has a fingerprint (value, length) in a monoid: ``(u, m) * (v, n) = (u + v * B^m, m + n)``,
the value being the sum of turn hash times B to its place, modulo two primes. A rebuilt conversation is
the head of its base followed by its own later turns; the fingerprints of all its prefixes follow from
those of the two originals by that product, so no rebuilt text ever exists. Prefixes of equal length and
value are one node. A row refers to its turn by a content number, which is exact; when the members of each
node agree in the last turn's number and in the node before, equal values are equal prefixes, by induction.
If they ever disagree, the fingerprints are made anew with another seed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.llm.common import kept, map_arrow, table
from riskloom.operators.running import SLICE, running_totals
from riskloom.session import shuffle_partitions

#: A conversation's base is the one with the next lower multiple of this as its id.
BASE_STEP = 5
#: A rebuilt conversation begins with up to MOST_HEAD - 1 turns of its base.
MOST_HEAD = 9
#: Primes below 2^31, so that products of two residues fit into a long, and the bases of the powers.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_347)
#: Turns, and ids, of a slice are 2 to this power apart at most.
SLICE_BITS, BLOCK_BITS = 12, 16
_LIMB = 8


def power(base: int, exponent: Column, prime: int) -> Column:
    """``base ** exponent % prime`` for exponents below 2^32, by looking up eight bits at a time."""
    out = None
    for shift in range(0, 32, _LIMB):
        # As one text: built value by value, such arrays cost the driver more than the query.
        powers = F.expr(f"array({', '.join(f'{pow(base, e << shift, prime)}L' for e in range(1 << _LIMB))})")
        limb = F.shiftright(exponent.cast("long"), shift).bitwiseAND(F.lit((1 << _LIMB) - 1))
        factor = F.get(powers, limb.cast("int"))
        out = factor if out is None else out * factor % prime
    return out


def _residues(name: str) -> list[str]:
    return [f"{name}{i}" for i in range(len(PRIMES))]


def turn_contents(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, hash, nth, bytes) per turn; turns are equal if and only if (hash, nth) are.

    ``nth`` numbers different turns of one hash value. Those are hardly ever any, so their table is
    empty or tiny and the join with it goes without moving the turns.
    """
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).filter("conv is not null")
    hashed = turns.withColumn("hash", content_hash(F.col("role"), F.col("text")))
    contents = hashed.select("hash", "role", "text").distinct()
    shared = contents.groupBy("hash").count().filter("count > 1").select("hash")
    nth = F.row_number().over(W.partitionBy("hash").orderBy("role", "text")) - 1
    clashes = kept(contents.join(shared, "hash").withColumn("nth", nth), "clashing-turns")
    numbered = hashed.join(clashes, ["hash", "role", "text"], "left")
    return numbered.select(
        "conv", "turn", "role", "hash", F.coalesce("nth", F.lit(0)).alias("nth"), F.octet_length("text").cast("long").alias("bytes")
    )


def content_hash(role: Column, text: Column) -> Column:
    return F.xxhash64(role, text)


def original_prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """Append ``i``, the place of a turn, its residues ``t0, t1``, and the value ``p0, p1`` of the prefix it ends.

    A conversation is ordered in slices of turn numbers, and the slices' fingerprints are multiplied
    up, so a very long one isn't one task's work.
    """
    cut = F.coalesce(F.shiftright(F.col("turn").cast("long"), SLICE_BITS), F.lit(-(1 << 62)))
    order = W.partitionBy("conv", SLICE).orderBy(F.asc_nulls_first("turn"), "role", "hash", "nth")
    placed = turns.withColumn(SLICE, cut).withColumn("j", F.row_number().over(order))
    for k, prime in enumerate(PRIMES):
        token = F.pmod(F.xxhash64("hash", "nth", F.lit(seed + k)), F.lit(prime - 1)) + 1
        placed = placed.withColumn(f"t{k}", token)
        placed = placed.withColumn(f"w{k}", F.col(f"t{k}") * power(BASES[k], F.col("j"), prime) % prime)
    inside = order.rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumns({f"q{k}": F.sum(f"w{k}").over(inside) for k in range(len(PRIMES))})
    rows = kept(placed.select("conv", SLICE, "j", "hash", "nth", "bytes", *_residues("t"), *_residues("w"), *_residues("q")), "turn-prefixes")

    along = W.partitionBy("conv").orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    slices = rows.groupBy("conv", SLICE).agg(F.count("*").alias("n"), *[F.sum(w).alias(w) for w in _residues("w")])
    slices = slices.withColumn("ahead", F.coalesce(F.sum("n").over(along), F.lit(0)))
    for k, prime in enumerate(PRIMES):
        lifted = F.col(f"w{k}") % prime * power(BASES[k], F.col("ahead"), prime) % prime
        slices = slices.withColumn(f"a{k}", F.coalesce(F.sum(lifted).over(along), F.lit(0)))
    joined = rows.join(slices.select("conv", SLICE, "ahead", *_residues("a")), ["conv", SLICE])
    whole = {
        f"p{k}": (F.col(f"a{k}") + F.col(f"q{k}") % prime * power(BASES[k], F.col("ahead"), prime)) % prime
        for k, prime in enumerate(PRIMES)
    }
    return joined.withColumns({"i": F.col("ahead") + F.col("j"), **whole}).select("conv", "i", "hash", "nth", "bytes", *_residues("t"), *_residues("p"))


def rebuilt_prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """(conv, depth, value, before, hash, nth, bytes, ends): every prefix of every rebuilt conversation.

    ``value`` packs both residues, ``before`` is the value one turn earlier, ``hash`` and ``nth`` name the
    last turn's content, and ``ends`` says that the rebuilt conversation has no more turns.
    """
    originals = kept(original_prefixes(turns, seed), "original-prefixes")
    most = MOST_HEAD - 1
    entry = F.struct("i", "hash", "nth", "bytes", *_residues("t"), *_residues("p"))
    heads = originals.groupBy("conv").agg(
        F.count("*").alias("length"), F.array_sort(F.collect_list(F.when(F.col("i") <= most, entry))).alias("head")
    )
    bases = heads.select(F.col("conv").alias("base"), F.col("head").alias("base_head"))
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % MOST_HEAD
    known = heads.withColumns({"base": F.col("conv") - F.col("conv") % BASE_STEP, "h": taken.cast("int")}).join(bases, "base", "left")
    known = known.withColumn("front", F.coalesce(F.slice("base_head", F.lit(1), F.col("h")), F.slice("head", 1, 0)))
    known = known.withColumn("from_base", F.size("front"))
    at = lambda items, n, field: F.coalesce(F.get(F.col(items), F.col(n) - 1)[field], F.lit(0))
    convs = known.select(
        "conv", "front", "h", "from_base",
        (F.col("from_base") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("total"),
        *[at("front", "from_base", p).alias(f"front_{p}") for p in _residues("p")],
        *[at("head", "h", p).alias(f"own_{p}") for p in _residues("p")],
    )
    convs = kept(convs, "rebuilt")

    fields = ("hash", "nth", "bytes", *_residues("t"), *_residues("p"))
    front = convs.select("conv", "total", F.explode("front").alias("x")).select(
        "conv", "total", F.col("x.i").alias("depth"), *[F.col(f"x.{f}").alias(f) for f in fields]
    )
    own = originals.join(convs.drop("front"), "conv").filter(F.col("i") > F.col("h"))
    for k, prime in enumerate(PRIMES):
        # The own turns move back by as many places as the base fell short of h.
        back = F.get(F.lit([pow(BASES[k], -m, prime) for m in range(MOST_HEAD)]), F.col("h") - F.col("from_base")).cast("long")
        suffix = F.pmod(F.col(f"p{k}") - F.col(f"own_p{k}"), F.lit(prime))
        own = own.withColumn(f"p{k}", (F.col(f"front_p{k}") + back * suffix) % prime)
    own = own.select("conv", "total", (F.col("from_base") + F.col("i") - F.col("h")).alias("depth"), *fields)
    rows = front.unionByName(own)
    before = [
        F.pmod(F.col(f"p{k}") - F.col(f"t{k}") * power(BASES[k], F.col("depth"), prime) % prime, F.lit(prime))
        for k, prime in enumerate(PRIMES)
    ]
    pack = lambda high, low: F.shiftleft(high, 31) + low
    rows = rows.select(
        "conv", "depth", pack(F.col("p0"), F.col("p1")).alias("value"), pack(*before).alias("before"),
        "hash", "nth", "bytes", (F.col("depth") == F.col("total")).alias("ends"),
    )
    zero = F.lit(0).cast("long")
    roots = convs.select(
        "conv", zero.alias("depth"), zero.alias("value"), zero.alias("before"), zero.alias("hash"),
        F.lit(0).alias("nth"), zero.alias("bytes"), (F.col("total") == 0).alias("ends"),
    )
    return rows.unionByName(roots)


def _nodes(rows: DataFrame) -> DataFrame:
    """One row per (depth, value), and whether its members agree in their last turn and in the node before."""
    checked = ("before", "hash", "nth")
    same = [F.min(c) == F.max(c) for c in checked]
    return rows.groupBy("depth", "value").agg(
        F.min("conv").alias("conv"),
        F.count("*").alias("n_convs"),
        F.min("before").alias("before"),
        F.min("bytes").alias("bytes"),
        (same[0] & same[1] & same[2]).alias("agree"),
    )


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, value, ends_sha256): the digest of each node's ids in order, comma-joined.

    Ids are joined in blocks of a bounded range of ids first; a node's blocks then pass through one
    digest in order, so no task ever holds all ids of a node.
    """
    listed = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    blocks = ends.groupBy("depth", "value", F.shiftright("conv", BLOCK_BITS).alias("block")).agg(listed.alias("ids"))
    tasks = shuffle_partitions(ends.sparkSession)
    ordered = blocks.repartition(tasks, "depth", "value").sortWithinPartitions("depth", "value", "block")
    return map_arrow(ordered, _digest_batches, "depth long, value long, ends_sha256 string")


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest = None, None
    for batch in batches:
        out: list[tuple[int, int, str]] = []
        depths, values, _, texts = (c.to_pylist() for c in batch.columns)
        for at, text in zip(zip(depths, values), texts):
            if at != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = at, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield _digest_rows(out)
    if node is not None:
        yield _digest_rows([(*node, digest.hexdigest())])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["depth", "value", "ends_sha256"])


def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", seed: int = 1
) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). A null role or
    text is empty. Turns go by number, null first; turns of one number by role and then in a fixed order of
    their contents; a repeated row is one more turn. Rows without a conversation id belong to none and are
    left out; other columns are not looked at. An empty table has no members, so not even a root.

    A subtree's sums need no walk: a node is owned by the smallest conversation through it. What
    conversations own below a node they share they own wholly, except the owner, of whose nodes those from the
    node's depth on count. So a sum is one grouped sum of what members own, and a running total.
    """
    spark = conversations.sparkSession
    turns = turn_contents(conversations, conv_id, turn, role, text)
    while True:
        rows = kept(rebuilt_prefixes(turns, seed), "prefixes")
        nodes = kept(_nodes(rows), "prefix-nodes")
        if nodes.filter(~F.col("agree")).isEmpty():
            break
        seed += len(PRIMES)
    key = ["depth", "value"]
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("value"))
        .agg(F.count("*").alias("n_children"))
    )
    known = nodes.drop("agree").join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    known = known.withColumns({"saved": (F.col("n_convs") - 1) * F.col("bytes"), "leaf": (F.col("n_children") == 0).cast("long")})
    known = kept(known, "prefix-nodes")

    sums = ("saved", "leaf")
    owned = known.groupBy("conv").agg(*[F.sum(c).alias(c) for c in sums])
    members = rows.select("conv", *key).join(owned, "conv").groupBy(*key).agg(*[F.sum(c).alias(f"below_{c}") for c in sums])
    down = known.withColumn(SLICE, -F.shiftright("depth", SLICE_BITS))
    chains = running_totals(down, ["conv"], [F.desc("depth")], {c: F.col(c) for c in sums})
    total = lambda c: F.col(f"below_{c}") - F.col(f"all_{c}") + F.col(f"cum_{c}")

    parents = known.select((F.col("depth") + 1).alias("depth"), F.col("value").alias("before"), F.col("conv").alias("parent_conv_id"))
    digests = _digests(rows.filter("ends").select("conv", *key))
    found = chains.join(members, key).join(digests, key, "left").join(parents, ["depth", "before"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        total("leaf").alias("n_leaves"),
        total("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def sql() -> str:
    """The same for DuckDB with whole prefixes as keys; CRC-32 bit by bit."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: {step})"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: {byte}), 4294967295)"
    return f"""
    WITH turns AS (
        SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
            struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said
        FROM conversations WHERE conv_id IS NOT NULL
    ),
    convs AS (SELECT conv_id, list(said ORDER BY i) AS said FROM turns GROUP BY conv_id),
    heads AS (SELECT *, conv_id - conv_id % {BASE_STEP} AS base, {crc} % {MOST_HEAD} AS h FROM convs),
    rebuilt AS (
        SELECT a.conv_id, list_concat(coalesce(b.said, [])[1:a.h], a.said[a.h + 1:]) AS said
        FROM heads a LEFT JOIN convs b ON b.conv_id = a.base
    ),
    prefixes AS (
        SELECT conv_id, depth, said[1:depth] AS path, depth = len(said) AS ends
        FROM (SELECT *, unnest(range(0, len(said) + 1)) AS depth FROM rebuilt)
    ),
    nodes AS (
        SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
            CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(any_value(path)[depth].text) END AS saved,
            sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
        FROM prefixes GROUP BY depth, path
    ),
    counted AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.path[1:n.depth] = n.path) AS n_children
        FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
    ),
    ups AS (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted),
    below AS (SELECT up, path[1:up] AS top, sum(saved) AS saved, count_if(n_children = 0) AS leaves FROM ups GROUP BY 1, 2)
    SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
        CAST(b.saved AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM counted n JOIN below b ON b.up = n.depth AND b.top = n.path
    """
