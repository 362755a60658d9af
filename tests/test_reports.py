"""The periodic report and the recent history, on tables and on streams."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskloom.operators import report
from riskloom.plans import fixtures as fx
from riskloom.session import work_dir
from riskloom.streaming import scoring as stream
from riskloom.streaming.history import kept_entries, read_history, recent_history_stream

SCHEMA = "ts timestamp, risk_score double, duration_us long, agreement double, model_us map<string,long>"


def test_cells_are_within_the_error(spark):
    values = [0, 1, 2, 3, 99, 100, 101, 12_345, 10**9, 2**53, 2**62]
    frame = spark.createDataFrame([(v,) for v in values], "us long").select("us", report.cell_value(report.latency_cell(F.col("us"))).alias("near"))
    for row in frame.collect():
        assert abs(row["near"] - row["us"]) <= report.ERROR * row["us"] * (1 + 1e-9)


def scored_rows(n=900):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        score = rng.choice([rng.random(), 0.56, 0.5, 1.0, 0.0])
        times = {m: int(rng.lognormvariate(4, 2)) for m in ("a", "b") if rng.random() < 0.7} or None
        if times and rng.random() < 0.1:
            times["a"] = None
        rows.append((i // 30 * 7.0 + rng.random(), score, None if i % 50 == 7 else int(rng.lognormvariate(6, 2)), rng.random() if i % 9 else None, times))
    return rows


def frame_of(spark, rows):
    made = spark.createDataFrame(rows, "s double, risk_score double, duration_us long, agreement double, model_us map<string,long>")
    return made.select(F.timestamp_seconds("s").alias("ts"), "risk_score", "duration_us", "agreement", "model_us")


def by_hand(rows, seconds=30):
    windows = defaultdict(list)
    for row in rows:
        windows[int(row[0] // seconds) * seconds].append(row)
    return windows


def ranks(values):
    ordered = sorted(values)
    return [ordered[int(len(ordered) * p)] for p in (0.5, 0.95, 0.99)]


def check(found, rows):
    windows = by_hand(rows)
    assert {r["window_start"].timestamp() for r in found} == set(windows)
    for r in found:
        mine = windows[r["window_start"].timestamp()]
        scores = [x[1] for x in mine]
        alerts = [s for s in scores if s >= 0.56]
        assert (r["processed"], r["alerts"]) == (len(mine), len(alerts))
        assert r["alert_rate"] == pytest.approx(100 * len(alerts) / len(mine)) and r["per_second"] == pytest.approx(len(mine) / 30)
        assert [r["level_low"], r["level_medium"], r["level_high"], r["level_critical"]] == [
            sum(low <= s < high for s in alerts) for low, high in ((-1, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 2))
        ]
        assert r["score_buckets"] == [sum(min(int(s * 10), 9) == b for s in scores) for b in range(10)]
        times = [x[2] for x in mine if x[2] is not None]
        assert (r["mean_us"], r["max_us"]) == (sum(times) // len(times), max(times))
        assert [r["p50_us"], r["p95_us"], r["p99_us"]] == [pytest.approx(x, rel=report.ERROR + 1e-9) for x in ranks(times)]
        agreed = [x[3] for x in mine if x[3] is not None]
        assert r["avg_agreement"] == pytest.approx(sum(agreed) / len(agreed))
        per = defaultdict(list)
        for x in mine:
            for model, us in (x[4] or {}).items():
                if us is not None:
                    per[model].append(us)
        assert [(m["model"], m["calls"], m["mean_us"]) for m in r["models"]] == [(m, len(v), sum(v) // len(v)) for m, v in sorted(per.items())]
        for m in r["models"]:
            assert [m["p50_us"], m["p95_us"], m["p99_us"]] == [pytest.approx(x, rel=report.ERROR + 1e-9) for x in ranks(per[m["model"]])]


def test_report_of_a_table(spark):
    rows = scored_rows()
    check(report.full_report(frame_of(spark, rows)).collect(), rows)
    lonely = [(5.0, 0.9, None, None, None)]
    row = report.full_report(frame_of(spark, lonely)).first()
    assert (row["processed"], row["alerts"], row["p99_us"], row["mean_us"], row["avg_agreement"], row["models"]) == (1, 1, None, None, None, [])
    assert report.full_report(frame_of(spark, lonely).limit(0)).count() == 0


def test_report_of_a_stream_leaves_the_state(spark):
    rows = scored_rows()
    folder, out, state = work_dir(spark, "test-report-in"), work_dir(spark, "test-report"), work_dir(spark, "test-report-state")
    schema = fx.arrivals(spark, frame_of(spark, rows).withColumn("model_us", F.to_json("model_us")), folder, batches=5, late_seconds=20)
    source = stream.table_source(spark, folder, schema).withColumn("model_us", F.from_json("model_us", "map<string,long>"))
    found = report.full_report(source.withWatermark("ts", "20 seconds"))
    query = stream.run_all(found.writeStream.format("parquet").option("path", out).outputMode("append"), state)
    check(spark.read.schema(found.schema).parquet(out).collect(), rows)
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert held[-1] <= 2 < max(held)  # the closing row's own window is all that is left
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 0


@pytest.mark.parametrize("cap", [1, 2, 7, 10])
def test_kept_entries(cap):
    held = []
    for pushed in range(1, 60):
        held.append(pushed)
        if len(held) > cap and cap > 1:
            del held[: cap // 2]
        if cap > 1:
            assert kept_entries(pushed, cap) == len(held)


def test_history_over_many_micro_batches(spark):
    rng, cap = random.Random(8), 20
    rows = [(i, i * 1_000_000 // 3, rng.choice("aab"), rng.randrange(1000)) for i in range(150)]
    rows += [(900, 5, None, 1), (901, 5, "c", None), (902, 7, "c", 3)]
    calls = spark.createDataFrame(rows, "event_id long, t long, model string, duration_us long")
    folder, out, state = work_dir(spark, "test-calls"), work_dir(spark, "test-history"), work_dir(spark, "test-history-state")
    schema = fx.arrivals(spark, calls.withColumn("ts", F.timestamp_micros("t")), folder, batches=6, late_seconds=1)
    found = recent_history_stream(stream.table_source(spark, folder, schema), cap)
    writer = found.writeStream.outputMode("update").foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{out}/batch={n}"))
    stream.run_all(writer, state)
    held = defaultdict(list)
    for name, t, model, us in sorted(rows, key=lambda r: (r[1], r[0])):
        if model is not None and us is not None:
            held[model].append((str(name), us))
            if len(held[model]) > cap:
                del held[model][: cap // 2]
    got = defaultdict(list)
    for r in read_history(spark, state).collect():
        got[r["key"]].append((r["id"], r["us"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in held.items()}
    stats = spark.read.parquet(out)
    assert stats.agg(F.max("calls")).first()[0] <= cap
    last = {r["key"]: r for r in stats.orderBy("pushed").collect()}
    for model, entries in held.items():
        times = [us for _, us in entries]
        assert [last[model][c] for c in ("calls", "mean_us", "p50_us", "p95_us", "p99_us", "max_us")] == [len(times), sum(times) // len(times), *ranks(times), max(times)]
