"""Labels and alerts that arrive together."""

from pyspark.sql import functions as F

from riskloom.plans import fixtures as fx
from riskloom.session import work_dir
from riskloom.streaming import quality
from riskloom.streaming import scoring as stream

MINUTE = 60


def test_late_missing_and_repeated_alerts_and_the_state(spark):
    # id, label's minute, alert minutes with scores
    cases = [
        ("early", 100, [(60, 0.9)]), ("late", 100, [(150, 0.8)]), ("too late", 100, [(190, 0.8)]), ("none", 120, []),
        ("repeated", 200, [(200, 0.7), (203, 0.95), (206, 0.6)]), ("tied", 300, [(300, 0.7), (300, 0.9)]),
        *[(f"r{i}", 10 * i, [(10 * i, 0.6)] if i % 3 == 0 else []) for i in range(60)],
    ]
    labels = [(name, name[0] == "r", m * MINUTE) for name, m, _ in cases] + [(None, True, 50 * MINUTE), ("no time", True, None)]
    alerts = [(name, score, m * MINUTE, "x") for name, _, told in cases for m, score in told]
    alerts += [("unlabelled", 0.9, 90 * MINUTE, "x"), (None, 0.9, 50 * MINUTE, "x")]
    sides = []
    for rows, schema in ((labels, "transaction_id string, label boolean, s long"), (alerts, "transaction_id string, risk_score double, s long, note string")):
        frame = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000)).drop("s")
        folder = work_dir(spark, "test-side")
        sides.append(stream.table_source(spark, folder, fx.arrivals(spark, frame, folder, batches=4)))
    out, state = work_dir(spark, "test-judged"), work_dir(spark, "test-judged-state")
    found = quality.labels_with_alerts(*sides)
    query = stream.run_all(found.writeStream.format("parquet").option("path", out).outputMode("append"), state)
    rows = spark.read.schema(found.schema).parquet(out).collect()
    got = {r["transaction_id"]: (r["has_alert"], r["predicted_score"]) for r in rows}
    missing = {n for n, _, _ in cases} - got.keys()
    assert not missing and len(rows) == len(cases) + 1 and got[None] == (False, 0.0)
    want = {"early": 0.9, "late": 0.8, "too late": None, "none": None, "repeated": 0.6, "tied": 0.9}
    want |= {f"r{i}": 0.6 if i % 3 == 0 else None for i in range(60)}
    assert {k: v for k, v in got.items() if k} == {k: (v is not None, v or 0.0) for k, v in want.items()}
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress]
    assert held[-1] <= 3 < max(held)  # the two closing rows are left


def test_arriving_rows_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(value):
        seen.add(1)
        return value

    rows = spark.range(500).select(F.udf(counted, "long")("id").alias("id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    folder = work_dir(spark, "test-once")
    schema = fx.arrivals(spark, rows, folder, batches=3)
    written = spark.read.schema(schema).parquet(folder)
    assert written.count() == 501 and written.filter("id is not null").distinct().count() == 500
    assert seen.value == 500
