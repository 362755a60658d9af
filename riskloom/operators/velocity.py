"""Velocity features of an event stream: what the same card did before each event.

A sliding window frame would be rebuilt for every row and would put a busy card into one task. So
each event is turned into *points* on its card's timeline instead: it adds to the counters when it
happens and takes off again when it leaves the last hour or the last 24 hours. A feature is then a
running total of points strictly before the event. A card with many points has its timeline cut into
slices (see :mod:`riskloom.operators.running`) of a bounded number of points, wherever in time they
lie: points are counted per card first, then per hour of busy cards, per minute of busy hours and
so on. The work per event is constant, and no task orders more than a slice.

Amounts are summed as decimals, which makes adding and taking off exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.operators.running import SLICE
from riskloom.session import ensure_checkpoint_dir

HOUR = 3_600_000_000
DAY = 24 * HOUR
FEATURES = (
    "tx_count_last_hour",
    "tx_amount_last_hour",
    "tx_count_last_24h",
    "tx_amount_last_24h",
    "unique_merchants_24h",
    "avg_tx_amount",
    "failed_tx_last_hour",
    "time_since_last_tx",
    "account_age_days",
)
AMOUNT = "decimal(20,6)"
_COUNTERS = {
    "tx_count_last_hour": "h_n",
    "tx_amount_last_hour": "h_amount",
    "tx_count_last_24h": "d_n",
    "tx_amount_last_24h": "d_amount",
    "unique_merchants_24h": "d_merchants",
    "failed_tx_last_hour": "h_failed",
}


@dataclass(frozen=True)
class EventColumns:
    """Names of the event table's columns and the test for a failed one."""

    card: str = "user_id"
    id: str = "event_id"
    ts: str = "ts"
    amount: str = "value"
    merchant: str = "event_type"
    failed: str = "event_type = 'error'"


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def calendar_fields(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour of day and day of week, Monday being 0."""
    return events.withColumns({"hour_of_day": F.hour(ts), "day_of_week": F.weekday(ts)})


#: Points that a slice holds at most, unless they all share a microsecond.
SLICE_POINTS = 100_000
#: Microseconds of the cells by which busy cards are counted, each inside the one before.
_CELLS = (3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)


def _busy_cells(points: DataFrame, keys: Sequence[str], most: int) -> list[DataFrame]:
    """Per level the groups, then the cells of time, that hold more than ``most`` points.

    ``points`` has the keys, a time ``t`` and ``weight``, the number of points there. Only rows of busy
    cells are counted again, more finely; there are fewer cells than points by ``most`` at each level.
    """
    busy: list[DataFrame] = []
    held = list(keys)
    for width in (None, *_CELLS):
        if width:
            points = points.join(busy[-1], held, "left_semi").withColumn(f"_cell_{width}", _cell(width))
            held = [*keys, f"_cell_{width}"]
        heavy = points.groupBy(*held).agg(F.sum("weight").alias("_points")).filter(F.col("_points") > most).select(*held)
        ensure_checkpoint_dir(points.sparkSession)
        busy.append(heavy.checkpoint())
        if busy[-1].isEmpty():
            return busy[:-1]
    return busy


def _cell(width: int) -> Column:
    return F.floor(F.col("t") / F.lit(width)).cast("long")


def _sliced(df: DataFrame, keys: Sequence[str], busy: Sequence[DataFrame]) -> DataFrame:
    """Append the slice: where the coarsest cell that is not busy begins, or 0 for a whole group."""
    out = df.withColumn(SLICE, F.lit(0).cast("long"))
    held = list(keys)
    for level, heavy in enumerate(busy):
        marked = out.join(heavy.withColumn("_busy", F.lit(True)), held, "left")
        if level == len(_CELLS):
            out = marked.drop("_busy")  # one microsecond cannot be cut
            break
        width = _CELLS[level]
        inside = F.when(F.col("_busy"), _cell(width))
        out = marked.withColumn(f"_cell_{width}", inside).withColumn(SLICE, F.coalesce(inside * width, SLICE)).drop("_busy")
        held = [*keys, f"_cell_{width}"]
    return out.drop(*[f"_cell_{w}" for w in _CELLS])


def _next_at_same_merchant(events: DataFrame, most: int) -> DataFrame:
    """Append ``t_next``: when the card next uses the same merchant, null if never."""
    keys = ["card", "merchant"]
    busy = _busy_cells(events.select(*keys, "t", F.lit(1).alias("weight")), keys, most)
    sliced = _sliced(events, keys, busy)
    inside = W.partitionBy(*keys, SLICE).orderBy("t", "id")
    firsts = sliced.groupBy(*keys, SLICE).agg(F.min("t").alias("first"))
    later = firsts.select(
        *keys, SLICE, F.lead("first").over(W.partitionBy(*keys).orderBy(SLICE)).alias("t_later")
    )
    return (
        sliced.withColumn("t_inside", F.lead("t").over(inside))
        .join(later, [*keys, SLICE])
        .select(*events.columns, F.coalesce("t_inside", "t_later").alias("t_next"))
    )


def velocity_features(
    events: DataFrame,
    wanted: Sequence[str] = FEATURES,
    names: EventColumns = EventColumns(),
    slice_points: int = SLICE_POINTS,
) -> DataFrame:
    """Event id and the wanted features; only the points those need are built.

    Hour and day frames hold the events at most that old and strictly earlier than the event. The
    average and the time since the last one go by arrival order ``(ts, id)``.
    """
    unknown = set(wanted) - set(FEATURES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    base = events.select(
        F.col(names.card).alias("card"),
        F.col(names.id).alias("id"),
        F.col(names.merchant).alias("merchant"),
        micros(F.col(names.ts)).alias("t"),
        F.col(names.amount).cast(AMOUNT).alias("amount"),
        F.expr(names.failed).cast("int").alias("failed"),
    ).filter("t is not null")
    hour = [f for f in wanted if f in ("tx_count_last_hour", "tx_amount_last_hour", "failed_tx_last_hour")]
    day = [f for f in wanted if f in ("tx_count_last_24h", "tx_amount_last_24h")]
    merchants = "unique_merchants_24h" in wanted
    # At most so many points come from an event: itself, leaving the hour and the day, and its merchant's end,
    # which is a day later or when another event happens.
    at = [(0, 1 + merchants), (HOUR, bool(hour)), (DAY, bool(day) + merchants)]
    weights = [F.struct((F.col("t") + shift).alias("t"), F.lit(int(n)).alias("weight")) for shift, n in at if n]
    busy = _busy_cells(base.select("card", F.inline(F.array(*weights))), ["card"], slice_points)
    if merchants:
        base = _next_at_same_merchant(base, slice_points)

    step = {
        "h_n": F.lit(1),
        "h_amount": F.col("amount"),
        "h_failed": F.col("failed"),
        "d_n": F.lit(1),
        "d_amount": F.col("amount"),
        "d_merchants": F.lit(1),
        "n": F.lit(1),
        "amount": F.col("amount"),
    }
    used = [_COUNTERS[f] for f in wanted if f in _COUNTERS]
    if "avg_tx_amount" in wanted:
        used += ["n", "amount"]

    def point(at: Column, is_event: bool, sign: int, counters: Sequence[str]) -> Column:
        zero = {"h_amount", "d_amount", "amount"}
        return F.struct(
            at.alias("t"),
            F.lit(is_event).alias("is_event"),
            *[
                (step[c] * sign if c in counters else F.lit(0).cast(AMOUNT if c in zero else "int"))
                .cast("decimal(28,6)" if c in zero else "int")
                .alias(c)
                for c in used
            ],
        )

    t = F.col("t")
    points = [point(t, True, 1, used)]
    if hour:
        points.append(point(t + HOUR, False, -1, [_COUNTERS[f] for f in hour]))
    if day:
        points.append(point(t + DAY, False, -1, [_COUNTERS[f] for f in day]))
    if merchants:
        # The event stands for its merchant until a later one does, a day at most.
        until = F.least(t + DAY, F.col("t_next"))
        points.append(point(until, False, -1, ["d_merchants"]))

    timeline = _sliced(base.select("card", "id", F.inline(F.array(*points))), ["card"], busy)
    event_time = F.when(F.col("is_event"), F.col("t"))

    by_time = W.partitionBy("card", SLICE).orderBy("t").rangeBetween(W.unboundedPreceding, -1)
    by_arrival = (
        W.partitionBy("card", SLICE).orderBy("t", "id").rowsBetween(W.unboundedPreceding, -1)
    )
    order = {c: by_arrival if c in ("n", "amount") else by_time for c in used}
    inside = timeline.withColumns(
        {
            **{f"_in_{c}": F.sum(c).over(order[c]) for c in used},
            "_in_last": F.max(event_time).over(by_arrival),
            "_in_first": F.min(event_time).over(by_arrival),
        }
    ).filter("is_event")

    earlier = W.partitionBy("card").orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    totals = timeline.groupBy("card", SLICE).agg(
        *[F.sum(c).alias(c) for c in used],
        F.max(event_time).alias("last"),
        F.min(event_time).alias("first"),
    )
    before = totals.select(
        "card",
        SLICE,
        *[F.sum(c).over(earlier).alias(f"_before_{c}") for c in used],
        F.max("last").over(earlier).alias("_before_last"),
        F.min("first").over(earlier).alias("_before_first"),
    )

    def total(c: str) -> Column:
        return F.coalesce(F.col(f"_in_{c}"), F.lit(0)) + F.coalesce(F.col(f"_before_{c}"), F.lit(0))

    # The events before this one in its slice come later than those of earlier slices.
    last = F.coalesce("_in_last", "_before_last")
    first = F.coalesce("_before_first", "_in_first", "t")

    def whole_days(at: Column) -> Column:
        return F.floor(at / F.lit(DAY))

    feature = {
        **{
            f: total(c).cast("double" if c.endswith("amount") else "long")
            for f, c in _COUNTERS.items()
            if c in used
        },
        "time_since_last_tx": F.floor((t - last) / F.lit(1_000_000)).cast("long"),
        "account_age_days": (whole_days(t) - whole_days(first)).cast("long"),
    }
    if "avg_tx_amount" in wanted:
        feature["avg_tx_amount"] = F.try_divide(
            total("amount").cast("double"), total("n").cast("double")
        )
    return inside.join(before, ["card", SLICE]).select(
        F.col("id").alias(names.id), *[feature[f].alias(f) for f in wanted]
    )
