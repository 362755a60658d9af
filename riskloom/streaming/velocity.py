"""Velocity features as events arrive: keyed state with timers, cards dealt over a fixed number of groups.

Events wait until the watermark has passed them and are then taken in order of time, so one that comes
late, though not too late, still counts for those after it. What happened in the last 24 hours lies in a
ring of minute buckets, each naming the next one that is not empty. Two marks run along the ring, an hour
and a day behind: what a mark passes is taken off its counters, and buckets behind the day's mark are
deleted, by a timer if nothing else happens. Work per event is constant; a card's state is a day of events,
the few that wait, and one row of totals that never goes. Results equal those of
:mod:`riskloom.operators.velocity`.

State is keyed by a group of cards, since each call of a Python processor and each of its state reads costs
a thousand times more than an event does. When a group has events to pass on, its cards' states are read at
once, worked on in memory, and written at once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType

from riskloom.operators.velocity import AMOUNT, DAY, FEATURES, HOUR, EventColumns, micros
from riskloom.session import ship_package

MINUTE = 60_000_000
#: Amounts are whole millionths here.
UNIT = 1_000_000
_COLUMNS = ("card", "t", "id", "merchant", "amount", "failed")
_WAITING = "card array<string>, t array<long>, id array<string>, merchant array<string>, amount array<long>, failed array<int>"
_KINDS = dict.fromkeys(FEATURES, "long") | dict.fromkeys(("tx_amount_last_hour", "tx_amount_last_24h", "avg_tx_amount"), "double")
_BUCKET = "following long, t array<long>, merchant array<string>, amount array<long>, failed array<int>"
# Sums of amounts are text, since they may exceed a long.
_TOTALS = (
    "n long, amount string, first long, last long, newest long, merchants long, "
    "h_minute long, h_at int, h_n long, h_amount string, h_failed long, "
    "d_minute long, d_at int, d_n long, d_amount string, d_failed long"
)
#: Stands for no minute and no time.
NONE = -(1 << 62)
#: The card of events without one.
NOBODY = ""
#: Groups that cards are dealt over; fixed for a checkpoint.
GROUPS = 1_024


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state beyond single values lies in RocksDB."""
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


@dataclass
class Mark:
    """The oldest event of a time frame by its place in the ring, and what the frame adds up to."""

    minute: int = NONE
    at: int = 0
    n: int = 0
    amount: int = 0
    failed: int = 0

    def count(self, sign: int, amount: int, failed: int) -> None:
        self.n, self.amount, self.failed = self.n + sign, self.amount + sign * amount, self.failed + sign * failed


@dataclass
class Bucket:
    """The events of one minute in order, and the next minute that has any."""

    following: int = NONE
    t: list[int] = field(default_factory=list)
    merchant: list[str | None] = field(default_factory=list)
    amount: list[int] = field(default_factory=list)
    failed: list[int] = field(default_factory=list)


class Ring:
    """One card's last day and totals, over states that are read when needed and written once."""

    def __init__(self, totals, minutes, merchants):
        self.totals, self.minutes, self.merchants = totals, minutes, merchants
        self.buckets: dict[int, Bucket] = {}
        self.changed: set[int] = set()
        self.gone: set[int] = set()
        self.counts: dict[str, int] = {}
        self.hour, self.day = Mark(), Mark()
        self.n, self.amount, self.first, self.last, self.newest, self.distinct = 0, 0, NONE, NONE, NONE, 0
        if totals.exists():
            row = list(totals.get())
            self.n, self.first, self.last, self.newest, self.distinct = row[0], *row[2:6]
            self.amount = int(row[1])
            self.hour = Mark(*row[6:9], int(row[9]), row[10])
            self.day = Mark(*row[11:14], int(row[14]), row[15])

    def write(self) -> None:
        for minute in self.gone:
            self.minutes.removeKey((minute,))
        for minute in self.changed - self.gone:
            b = self.buckets[minute]
            self.minutes.updateValue((minute,), (b.following, b.t, b.merchant, b.amount, b.failed))
        for merchant, n in self.counts.items():
            if n:
                self.merchants.updateValue((merchant,), (n,))
            elif self.merchants.containsKey((merchant,)):
                self.merchants.removeKey((merchant,))
        marks = [x for m in (self.hour, self.day) for x in (m.minute, m.at, m.n, str(m.amount), m.failed)]
        self.totals.update((self.n, str(self.amount), self.first, self.last, self.newest, self.distinct, *marks))

    def bucket(self, minute: int) -> Bucket:
        if minute not in self.buckets:
            following, *columns = self.minutes.getValue((minute,))
            self.buckets[minute] = Bucket(following, *map(list, columns))
        return self.buckets[minute]

    def count_merchant(self, merchant: str | None, step: int) -> None:
        if merchant is None:
            return
        if merchant not in self.counts:
            known = self.merchants.containsKey((merchant,))
            self.counts[merchant] = self.merchants.getValue((merchant,))[0] if known else 0
        before = self.counts[merchant]
        self.counts[merchant] = before + step
        self.distinct += (before + step > 0) - (before > 0)

    def add(self, t: int, merchant: str | None, amount: int, failed: int) -> None:
        """Append the newest event."""
        minute = t // MINUTE
        if minute != self.newest:
            if self.newest != NONE:
                self.bucket(self.newest).following = minute
                self.changed.add(self.newest)
            self.buckets[minute] = Bucket()
            self.gone.discard(minute)
            self.newest = minute
        bucket = self.bucket(minute)
        for column, value in zip((bucket.t, bucket.merchant, bucket.amount, bucket.failed), (t, merchant, amount, failed)):
            column.append(value)
        self.changed.add(minute)
        for mark in (self.hour, self.day):
            if mark.minute == NONE:
                mark.minute, mark.at = minute, len(bucket.t) - 1
            mark.count(1, amount, failed)
        self.count_merchant(merchant, 1)
        self.n, self.amount = self.n + 1, self.amount + amount
        self.first, self.last = t if self.first == NONE else self.first, t

    def move(self, t: int) -> None:
        """Bring the marks to an hour and a day before ``t``; the hour's mark is never behind the day's."""
        for mark, since in ((self.hour, t - HOUR), (self.day, t - DAY)):
            while mark.minute != NONE:
                bucket = self.bucket(mark.minute)
                while mark.at < len(bucket.t) and bucket.t[mark.at] < since:
                    mark.count(-1, bucket.amount[mark.at], bucket.failed[mark.at])
                    if mark is self.day:
                        self.count_merchant(bucket.merchant[mark.at], -1)
                    mark.at += 1
                if mark.at < len(bucket.t):
                    break
                left, mark.minute, mark.at = mark.minute, bucket.following, 0
                if mark is self.day:
                    self.gone.add(left)
                    if self.newest == left:
                        self.newest = NONE

    def features(self, t: int) -> dict[str, int | float | None]:
        """Features of an event at ``t`` from what was added so far, the marks being moved."""
        return {
            "tx_count_last_hour": self.hour.n,
            "tx_amount_last_hour": self.hour.amount / UNIT,
            "tx_count_last_24h": self.day.n,
            "tx_amount_last_24h": self.day.amount / UNIT,
            "unique_merchants_24h": self.distinct,
            "avg_tx_amount": self.amount / UNIT / self.n if self.n else None,
            "failed_tx_last_hour": self.hour.failed,
            "time_since_last_tx": None if self.last == NONE else (t - self.last) // UNIT,
            "account_age_days": 0 if self.first == NONE else t // DAY - self.first // DAY,
        }

    def take(self, events: list[tuple]) -> list[dict]:
        """Features of events in order. Time frames do not see events of the same microsecond, arrival order does."""
        rows = []
        for t, together in groupby(events, key=lambda e: e[0]):
            self.move(t)
            by_time = self.features(t)
            for _, name, merchant, amount, failed in list(together):
                by_arrival = {k: v for k, v in self.features(t).items() if k in ("avg_tx_amount", "time_since_last_tx", "account_age_days")}
                rows.append({"id": name, **by_time, **by_arrival})
                self.add(t, merchant, amount, failed)
        return rows


class _Value:
    """A card's row of totals while its group is worked on."""

    def __init__(self, row: tuple | None = None):
        self.row = row

    def exists(self) -> bool:
        return self.row is not None

    def get(self) -> tuple | None:
        return self.row

    def update(self, row: tuple) -> None:
        self.row = row


class _Map(dict):
    """A card's minutes or merchants while its group is worked on."""

    containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__  # noqa: N815

    def removeKey(self, key: tuple) -> None:  # noqa: N802
        self.pop(key, None)


def _held(state) -> list[tuple]:
    return [tuple(row) for row in state.get()] if state.exists() else []


def _replace(state, before: list, rows: list[tuple]) -> None:
    if rows:
        state.put(rows)
    elif before:
        state.clear()


class CardVelocity(StatefulProcessor):
    """Lets the events of a group of cards wait for the watermark, and passes them through the cards' rings."""

    def __init__(self, number: bool, wanted: Sequence[str]):
        self.number, self.wanted = number, list(wanted)

    def order(self, event: tuple) -> tuple:
        """By time, then by id, null first; ids travel as text, also numbers."""
        t, name = event[:2]
        return t, name is not None, name if name is None or not self.number else int(name)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.passed: dict[int, int] = {}
        self.totals = handle.getListState("totals", f"card string, {_TOTALS}")
        self.waiting = handle.getListState("waiting", _WAITING)
        self.minutes = handle.getListState("minutes", f"card string, minute long, {_BUCKET}")
        self.merchants = handle.getListState("merchants", "card string, merchant string, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, soonest = [], None
        for frame in rows:
            frame = frame[frame["card"] != NOBODY]
            if len(frame):
                parts.append(tuple(frame[c].astype(object).where(frame[c].notna(), None).tolist() for c in _COLUMNS))
                first = int(frame["t"].min())
                soonest = first if soonest is None else min(soonest, first)
        if parts:
            self.waiting.appendList(parts)
            self._wake(soonest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        # Timers come after a micro-batch's rows, so a group's second one finds nothing new.
        if self.passed.get(key[0]) == passed:
            return iter(())
        self.passed[key[0]] = passed
        ripe, unripe = defaultdict(list), []
        waiting = _held(self.waiting)
        for part in waiting:
            for card, *event in zip(*part):
                if event[0] <= passed:
                    ripe[card].append(event)
                else:
                    unripe.append((card, *event))
        old = [_held(state) for state in (self.totals, self.minutes, self.merchants)]
        totals, minutes, merchants = defaultdict(_Value), defaultdict(_Map), defaultdict(_Map)
        for card, *row in old[0]:
            totals[card].update(tuple(row))
        for states, rows in ((minutes, old[1]), (merchants, old[2])):
            for card, name, *row in rows:
                states[card][(name,)] = tuple(row)
        found, ends = [], []
        for card in dict.fromkeys([*ripe, *minutes]):
            ring = Ring(totals[card], minutes[card], merchants[card])
            found += ring.take(sorted(ripe.get(card, ()), key=self.order))
            ring.move(passed)
            ring.write()
            if ring.newest != NONE:
                ends.append(ring.last)
        _replace(self.totals, old[0], [(card, *value.row) for card, value in totals.items()])
        for state, before, states in ((self.minutes, old[1], minutes), (self.merchants, old[2], merchants)):
            _replace(state, before, [(card, *name, *row) for card, held in states.items() for name, row in held.items()])
        if ripe:
            _replace(self.waiting, waiting, [tuple(map(list, zip(*unripe)))] if unripe else [])
        if unripe:
            self._wake(min(e[1] for e in unripe))
        elif ends:
            self._wake(min(ends) + DAY + 1000)
        if not found:
            return iter(())
        kinds = {"long": "Int64", "double": "float64"}
        frame = pd.DataFrame(found)[["id", *self.wanted]]
        return iter([frame.astype({f: kinds[_KINDS[f]] for f in self.wanted})])

    def _wake(self, t: int) -> None:
        """Timers are in milliseconds; this one is not before ``t``."""
        self.handle.registerTimer(-(-t // 1000))

    def close(self) -> None:
        pass


def velocity_stream(
    events: DataFrame, wanted: Sequence[str] = FEATURES, names: EventColumns = EventColumns(), delay: str = "10 minutes"
) -> DataFrame:
    """Event id and the wanted features of a stream, each event once, when the watermark has passed it.

    Events may come ``delay`` out of order; Spark drops what is later still. Events without a card or a
    time have no features; a null amount adds nothing and a null merchant is none. The last ``delay`` of a
    stream is held back until something later arrives; any row will do, also one without a card.
    """
    unknown = set(wanted) - set(FEATURES)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    use_rocksdb(events.sparkSession)
    ship_package(events.sparkSession)
    id_type = events.schema[names.id].dataType
    amount = F.coalesce(F.col(names.amount).cast(AMOUNT), F.lit(0).cast(AMOUNT)) * UNIT
    base = events.select(
        # Never null, and text: pandas would make whole numbers beside nulls floating-point ones.
        F.coalesce(F.concat(F.lit("="), F.col(names.card).cast("string")), F.lit(NOBODY)).alias("card"),
        F.col(names.ts).cast("timestamp").alias("ts"),
        micros(F.col(names.ts)).alias("t"),
        F.col(names.id).cast("string").alias("id"),
        F.col(names.merchant).cast("string").alias("merchant"),
        amount.cast("long").alias("amount"),
        F.coalesce(F.expr(names.failed).cast("int"), F.lit(0)).alias("failed"),
    )
    kept = base.filter("ts is not null").withWatermark("ts", delay)
    kept = kept.withColumn("cards", F.pmod(F.xxhash64("card"), F.lit(GROUPS)).cast("int"))
    schema = "id string, " + ", ".join(f"{f} {_KINDS[f]}" for f in wanted)
    found = kept.groupBy("cards").transformWithStateInPandas(
        CardVelocity(isinstance(id_type, IntegralType), wanted), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return found.select(F.col("id").cast(id_type).alias(names.id), *wanted)
