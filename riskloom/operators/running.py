"""Exact running totals over an ordered table that no single task ever holds.

A plain window without a partition key, or with a very uneven one, would sort everything in one
task. Here every ordered group is cut into *slices* along its order. Each slice is summed in its own
task, the slice totals (one row per slice) give what came before, and the two are joined. Results
equal the plain window's; the tests compare them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = "_slice"
#: Slices for each doubling of a value: about 40,000 for scores down to a thousandth.
SLICES_PER_OCTAVE = 4096


def slice_by_value(df: DataFrame, value: str, descending: bool = False, slices: int = SLICES_PER_OCTAVE) -> DataFrame:
    """Number the rows' slices along ``value``: fixed cells, ``slices`` of them for each doubling.

    Plain arithmetic that never falls as the value rises; nothing is measured first, and where the
    bounds lie does not change any result. Values below a millionth share the middle slice, equal
    values share any. Nulls come first and NaN last, as in Spark's order.
    """
    x = F.col(value).cast("double")
    spread = F.signum(x) * F.log2(1.0 + F.abs(x) * 1e6) * slices
    cell = F.floor(F.greatest(F.lit(-1e9), F.least(F.lit(1e9), spread))).cast("int")
    position = F.when(x.isNull(), F.lit(-2_000_000_000)).when(F.isnan(x), F.lit(2_000_000_000)).otherwise(cell)
    return df.withColumn(SLICE, -position if descending else position)


def slice_by_hash(df: DataFrame, digest: str, digits: int = 3) -> DataFrame:
    """Slices of a hexadecimal digest ordered by its text; even by nature, so nothing is measured."""
    return df.withColumn(SLICE, F.substring(digest, 1, digits))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Mapping[str, Column],
) -> DataFrame:
    """Append ``cum_<name>`` (up to and with the row) and ``all_<name>`` (whole group) per value.

    ``df`` has a slice column that rises along ``order``. Groups must not have null keys.
    """
    inside = W.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    rows = df.withColumns({f"_in_{n}": F.sum(v).over(inside) for n, v in values.items()})
    before = slice_offsets(df, keys, {n: F.sum(v) for n, v in values.items()})
    return rows.join(before, [*keys, SLICE]).select(
        *df.columns,
        *[(F.col(f"_in_{n}") + F.col(f"_before_{n}")).alias(f"cum_{n}") for n in values],
        *[F.col(f"all_{n}") for n in values],
    )


def slice_offsets(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per slice: what all earlier slices of the group add up to, and the group's total."""
    totals = df.groupBy(*keys, SLICE).agg(*[s.alias(f"_sum_{n}") for n, s in sums.items()])
    along = W.partitionBy(*keys).orderBy(SLICE)
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return totals.select(
        *keys,
        SLICE,
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"all_{n}") for n in sums],
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Occurrences per distinct value with their running count, values ascending."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return running_totals(slice_by_value(counts, value), keys, [F.asc(value)], {"n": F.col("n")})


def value_at(rank: Column, value: str) -> Column:
    """Aggregate over :func:`value_counts`: the value at a 0-based rank of the sorted rows."""
    inside = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
    return F.max(F.when(inside, F.col(value)))
