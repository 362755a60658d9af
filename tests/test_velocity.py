"""Velocity where cards are busy, and on streams."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import velocity
from riskloom.operators.running import SLICE
from riskloom.plans import fixtures as fx
from riskloom.session import work_dir
from riskloom.streaming import scoring as stream
from riskloom.streaming.velocity import NONE, CardVelocity, Ring, velocity_stream
from test_operators import brute_velocity

SCHEMA = "event_id long, user_id int, event_type string, ts timestamp_ntz, value double"


def plain(rows):
    return {
        r["event_id"]: tuple(
            round(x, 6 if f == "avg_tx_amount" else 2) if isinstance(x, float) else x
            for f, x in ((f, r[f]) for f in velocity.FEATURES)
        )
        for r in rows
    }


def test_slices_of_a_hot_card_are_bounded(spark):
    """A million events of one card within an hour, most of them within a second, beside quiet cards."""
    most = 20_000
    second = F.when(F.col("id") % 4 == 0, F.col("id") * 3_600 % 3_600_000_000).otherwise(F.col("id") % 1_000_000)
    points = spark.range(1_000_000).select(F.lit("hot").alias("card"), second.alias("t"), F.lit(1).alias("weight"))
    quiet = spark.range(1_000).select(F.concat(F.lit("c"), F.col("id") % 50).alias("card"), (F.col("id") * 10**9).alias("t"), F.lit(1).alias("weight"))
    points = points.unionByName(quiet)
    busy = velocity._busy_cells(points, ["card"], most)
    sliced = velocity._sliced(points, ["card"], busy).groupBy("card", SLICE).agg(F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    rows = sorted(sliced.collect(), key=lambda r: (r["card"], r[SLICE]))
    assert sum(r["n"] for r in rows) == 1_001_000 and max(r["n"] for r in rows) <= most
    assert all(a["high"] < b["low"] for a, b in zip(rows, rows[1:]) if a["card"] == b["card"])
    assert {r[SLICE] for r in rows if r["card"] != "hot"} == {0}


def test_one_microsecond_is_not_cut(spark):
    points = spark.range(50).select(F.lit("hot").alias("card"), (F.col("id") % 2).alias("t"), F.lit(1).alias("weight"))
    sliced = velocity._sliced(points, ["card"], velocity._busy_cells(points, ["card"], 10))
    assert sorted((r[SLICE], r["count"]) for r in sliced.groupBy(SLICE).count().collect()) == [(0, 25), (1, 25)]


def test_hot_card_against_a_plain_window(spark):
    """Most events within minutes, in slices of at most 500 points, against Spark's own frames."""
    micros = F.when(F.col("id") % 3 > 0, F.col("id") * 37_003 % 600_000_000).otherwise(F.col("id") * 7_919_000_003 % (5 * velocity.DAY))
    events = spark.range(6_000).select(
        F.col("id").alias("event_id"), (F.col("id") % 50 == 0).cast("int").alias("user_id"),
        F.element_at(F.array(F.lit("click"), F.lit("error"), F.lit("view")), (F.col("id") % 3 + 1).cast("int")).alias("event_type"),
        F.timestamp_micros(micros).alias("ts"), (F.col("id") % 101 / 4.0).alias("value"),
    ).persist()
    wanted = ["tx_count_last_hour", "tx_count_last_24h", "unique_merchants_24h", "failed_tx_last_hour"]
    got = velocity.velocity_features(events, wanted, slice_points=500)
    events.withColumn("t", F.unix_micros("ts")).createOrReplaceTempView("hot_events")
    frame = "over (partition by user_id order by t range between {} preceding and 1 preceding)"
    hour, day = frame.format(f"{velocity.HOUR}L"), frame.format(f"{velocity.DAY}L")
    expected = spark.sql(f"""
        select event_id, count(*) {hour} as tx_count_last_hour, count(*) {day} as tx_count_last_24h,
               cast(size(collect_set(event_type) {day}) as bigint) as unique_merchants_24h,
               count_if(event_type = 'error') {hour} as failed_tx_last_hour from hot_events""")
    assert got.count() == 6_000
    assert got.exceptAll(expected).isEmpty()


def random_events(n=240):
    rng, start, rows = random.Random(12), datetime(2024, 1, 1), []
    for e in range(n):
        card = 1 if e % 3 else rng.randrange(2, 7)
        t = start + timedelta(minutes=30 * rng.randrange(0, 300), microseconds=rng.choice([0, 0, 1]))
        rows.append((e, card, rng.choice(["click", "error", "view"]), t, round(rng.uniform(0.01, 400), 2)))
    return rows


def test_stream_equals_brute_force_and_state_is_a_day(spark):
    rows = random_events()
    odd = [(9_001, None, "click", datetime(2024, 1, 2), 1.0), (9_002, 1, "click", None, 1.0)]
    events = spark.createDataFrame(rows + odd, SCHEMA)
    folder, out, state = work_dir(spark, "test-arrivals"), work_dir(spark, "test-velocity"), work_dir(spark, "test-velocity-state")
    schema = fx.arrivals(spark, events, folder, batches=4)
    found = velocity_stream(stream.table_source(spark, folder, schema))
    query = stream.run_all(found.writeStream.format("parquet").option("path", out), state)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 4
    read = spark.read.schema(found.schema).parquet(out).collect()
    assert len(read) == len(rows) and plain(read) == brute_velocity(rows)
    # All is older than a day by the end, so the rings are empty and only totals are left.
    left = lambda name: spark.read.format("statestore").option("stateVarName", name).load(state).count()
    assert left("minutes") == 0 and left("merchants") == 0 and left("waiting") == 0
    assert left("totals") == len({r[1] for r in rows})


class Value:
    def __init__(self):
        self.row = None

    def exists(self):
        return self.row is not None

    def get(self):
        return self.row

    def update(self, row):
        self.row = row


class Map(dict):
    containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__  # noqa: N815

    def removeKey(self, key):  # noqa: N802
        self.pop(key, None)


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_ring_holds_a_day_however_events_are_dealt(step):
    rows = sorted(((int(r[3].timestamp() * 1e6), r[0], r[2], round(r[4] * 1e6), int(r[2] == "error")) for r in random_events(600) if r[1] == 1))
    states, found, most = (Value(), Map(), Map()), [], 0
    for i in range(0, len(rows), step):
        part = rows[i : i + step]
        ring = Ring(*states)
        found += ring.take(part)
        ring.write()
        last = part[-1][0]
        held = [t for b in states[1].values() for t in b[1]]
        since = [r for r in rows if r[0] <= last and r[0] // 60_000_000 >= (last - velocity.DAY) // 60_000_000]
        assert len(held) <= len(since)
        most = max(most, len(held))
    assert 0 < most < len(rows) or step == 1000
    if step == 1000:
        expected = brute_velocity([(r[1], 1, r[2], datetime.fromtimestamp(r[0] / 1e6), r[3] / 1e6) for r in rows])
        assert plain([{"event_id": f["id"], **f} for f in found]) == expected
    ring = Ring(*states)
    ring.move(rows[-1][0] + velocity.DAY + 1)
    ring.write()
    assert not states[1] and not states[2] and ring.newest == NONE


class Listed(list):
    """A list state that counts how often it is called."""

    calls = 0

    def __getattribute__(self, name):
        if name in ("exists", "get", "put", "appendList", "clear"):
            Listed.calls += 1
        return super().__getattribute__(name)

    def exists(self):
        return bool(self)

    def get(self):
        return iter(list(self))

    def put(self, rows):
        self[:] = rows

    def appendList(self, rows):  # noqa: N802
        self.extend(rows)


class Handle:
    def __init__(self):
        self.timers = set()

    def getListState(self, name, schema):  # noqa: N802
        return Listed()

    def registerTimer(self, ms):  # noqa: N802
        self.timers.add(ms)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def test_state_calls_do_not_grow_with_cards():
    rng, start, most = random.Random(5), datetime(2024, 1, 1), {}
    for cards in (3, 300):
        rows = [(e, f"c{e % cards}", rng.choice(["click", "error"]), start + timedelta(minutes=rng.randrange(6_000)), 1.0) for e in range(1_200)]
        found, handle, states = [], Handle(), None
        Listed.calls = 0
        for part, passed in ((rows[:5], 0), (rows[5:600], 0), (rows[600:], int(start.timestamp()) * 1_000 + 10**9)):
            processor = CardVelocity(True, velocity.FEATURES)  # each micro-batch has its own
            processor.init(handle)
            states = states or [processor.totals, processor.waiting, processor.minutes, processor.merchants]
            processor.totals, processor.waiting, processor.minutes, processor.merchants = states
            frame = pd.DataFrame([(r[1], int(r[3].timestamp()) * 10**6, str(r[0]), r[2], 10**6, int(r[2] == "error")) for r in part])
            frame.columns = ["card", "t", "id", "merchant", "amount", "failed"]
            assert not list(processor.handleInputRows((0,), iter([frame]), None))
            found += [f for _ in range(2) for f in processor.handleExpiredTimer((0,), Watermark(passed), None)]
        most[cards] = Listed.calls
        got = plain({**r, "event_id": int(r["id"])} for f in found for r in f.astype(object).where(f.notna(), None).to_dict("records"))
        assert got == brute_velocity(rows)
        assert [len(s) for s in states] == [cards, 0, 0, 0]
    assert most[300] == most[3] <= 40
