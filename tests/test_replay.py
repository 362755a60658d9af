"""Replay at a bounded rate and publishing in one step, over failures and restarts."""

import time

import pytest
from pyspark.sql import functions as F

from riskloom.session import work_dir
from riskloom.sources import replay


@pytest.fixture(scope="module")
def stored(spark):
    folder = work_dir(spark, "test-stored")
    rows = spark.range(3_000).select(F.col("id"), F.concat(F.lit("é"), F.col("id")).alias("name"))
    rows.repartition(3).sortWithinPartitions("id").write.option("parquet.block.size", 4_096).parquet(folder)
    return folder


def test_parts_of_files_are_exact(spark, stored, monkeypatch):
    monkeypatch.setattr(replay, "TASK_ROWS", 700)
    reader = replay.ReplayReader(stored, 1e9, 0.0, ["name", "id"])
    assert reader.latestOffset() == {"row": 3_000} and reader.partitions({"row": 50}, {"row": 50}) == []
    seen = []
    for low, high in ((0, 1), (1, 1_500), (1_500, 2_999), (2_999, 3_000)):
        parts = reader.partitions({"row": low}, {"row": high})
        assert all(p.last - p.first <= 700 for p in parts) and sum(p.last - p.first for p in parts) == high - low
        seen += [i for p in parts for b in reader.read(p) for i in b.column(1).to_pylist()]
    assert sorted(seen) == list(range(3_000))


def test_rate_is_bounded(stored, monkeypatch):
    reader = replay.ReplayReader(stored, 100.0, 1_000.0, ["id"])
    for now, row in ((900.0, 0), (1_000.0, 0), (1_005.5, 550), (1_100.0, 3_000)):
        monkeypatch.setattr(replay.time, "time", lambda now=now: now)
        assert reader.latestOffset() == {"row": row}


def test_failed_commit_and_restart(spark, stored):
    """A commit that fails stops the stream; started again it leaves every row once."""
    out, state, started = work_dir(spark, "test-published"), work_dir(spark, "test-published-state"), time.time()
    rows = replay.replayed(spark, stored, 150.0, started).withColumn("out", F.lit(out))
    assert rows.isStreaming

    class Failing(replay.PublishingWriter):
        def commit(self, messages, batchId):  # noqa: N803
            if batchId == 1:
                raise RuntimeError("lost before the rename")
            super().commit(messages, batchId)

        def abort(self, messages, batchId):  # noqa: N803
            raise RuntimeError("lost before cleaning up")

    class FailingSource(replay.ReplaySource):
        @classmethod
        def name(cls):
            return "riskloom_failing"

        def streamWriter(self, schema, overwrite):  # noqa: N802
            return Failing(self.options["path"], schema.names)

    spark.dataSource.register(FailingSource)
    writer = rows.writeStream.format("riskloom_failing").option("path", out).option("checkpointLocation", state)
    query = writer.trigger(processingTime="1 second").start()
    with pytest.raises(Exception, match="lost before|riskloom|failed"):
        query.awaitTermination(60)
    left = lambda: replay.published(spark, out, "id long, name string")
    assert 0 <= left().count() < 3_000
    again = replay.publishing(replay.replayed(spark, stored, 150.0, started).withColumn("out", F.lit(out)), out)
    query = again.option("checkpointLocation", state).trigger(processingTime="1 second").start()
    deadline = time.time() + 90
    while left().count() < 3_000 and time.time() < deadline:
        time.sleep(1)
    query.stop()
    found = left()
    assert found.count() == 3_000 and found.select("id").distinct().count() == 3_000
    assert found.filter(F.col("name") != F.concat(F.lit("é"), F.col("id"))).isEmpty()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 1


def test_a_task_holds_a_few_thousand_rows_at_a_time(spark):
    """Whatever the size of a row group, and nothing is read past the task's last row."""
    folder = work_dir(spark, "test-wide")
    spark.range(30_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 512).alias("text")).coalesce(1).write.parquet(folder)
    reader = replay.ReplayReader(folder, 1e9, 0.0, ["id", "text"])
    for low, high in ((0, 30_000), (9_000, 19_001), (29_999, 30_000)):
        batches = [b for p in reader.partitions({"row": low}, {"row": high}) for b in reader.read(p)]
        assert [i for b in batches for i in b.column(0).to_pylist()] == list(range(low, high))
        assert max(b.num_rows for b in batches) <= 5_000
