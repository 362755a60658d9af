"""Scoring as a stream: sources, sinks, reject handling, totals and windows.

Files stand in for a broker in tests; :func:`kafka_source` and :func:`kafka_sink` name the options a
cluster needs. A stream reads its messages once and is restarted from its checkpoint, so every sink
here gives the same output when a micro-batch is repeated.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from riskloom.functions.scoring import at_least, risk_level, score_bucket
from riskloom.params import ScoringParams
from riskloom.plans.scoring import build_alerts, predict_scores
from riskloom.sources import wire

Scorer = Callable[[DataFrame], DataFrame]


# --- sources and sinks --------------------------------------------------------------------------


def file_source(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON text messages from files, one per line, a bounded number of files per micro-batch."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(folder)


def table_source(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """Rows of Parquet files in the order in which the files came, a bounded number of files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def kafka_source(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None) -> DataFrame:
    """Messages of a topic as text; needs Spark's Kafka package on the cluster."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def run_all(writer, checkpoint: str) -> StreamingQuery:
    """Process what is there, in as many micro-batches as the source makes, and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_for(writer, checkpoint: str, rows: int, seconds: float = 300.0) -> StreamingQuery:
    """Process an endless source until so many rows were read and their micro-batch is done, and stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime="500 milliseconds").start()
    ends = time.monotonic() + seconds
    try:
        while sum(p["numInputRows"] for p in query.recentProgress) < rows:
            if time.monotonic() > ends:
                raise TimeoutError(f"{rows} rows did not come within {seconds} s")
            query.awaitTermination(0.2)
    finally:
        query.stop()
    return query


def file_sink(alerts: DataFrame, folder: str):
    """Alerts as JSON lines. The file sink commits each micro-batch exactly once."""
    return alerts.writeStream.format("json").option("path", folder).outputMode("append")


def kafka_sink(alerts: DataFrame, servers: str, topic: str):
    """Alerts to a topic, keyed by transaction; consumers drop repeats by the stable alert id."""
    return (
        wire.to_alert_json(alerts)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )


# --- jobs ---------------------------------------------------------------------------------------


def scored_stream(messages: DataFrame, scorer: Scorer, models: Sequence[str], params: ScoringParams) -> DataFrame:
    """Accepted messages with their prediction; the batch functions, unchanged."""
    return predict_scores(scorer(wire.accepted(wire.decode_transactions(messages))), models, params)


def alert_stream(messages: DataFrame, scorer: Scorer, models: Sequence[str], params: ScoringParams) -> DataFrame:
    return build_alerts(scored_stream(messages, scorer, models, params), params)


def split_batches(
    messages: DataFrame,
    scorer: Scorer,
    models: Sequence[str],
    params: ScoringParams,
    alerts_folder: str,
    rejects_folder: str,
):
    """Alerts and rejects of each micro-batch to two places, from one decoding of it.

    A batch's output replaces its own folder, so a repeated batch leaves no duplicates.
    """

    def write(batch: DataFrame, number: int) -> None:
        decoded = wire.decode_transactions(batch.withColumn("message", F.col("value"))).persist()
        try:
            scored = predict_scores(scorer(wire.accepted(decoded)), models, params)
            alerts = build_alerts(scored, params)
            alerts.write.mode("overwrite").json(f"{alerts_folder}/batch={number}")
            rejects = wire.rejected(decoded, "message")
            rejects.write.mode("overwrite").json(f"{rejects_folder}/batch={number}")
        finally:
            decoded.unpersist()

    return messages.writeStream.foreachBatch(write)


def running_totals(predicted: DataFrame, params: ScoringParams) -> DataFrame:
    """Totals since the start by level and score bucket; 40 groups of state at most."""
    score = F.col("risk_score")
    return predicted.groupBy(
        risk_level(score, params.bounds).alias("risk_level"), score_bucket(score).alias("bucket")
    ).agg(
        F.count("*").alias("processed"),
        F.count_if(at_least(score, params.alert_threshold)).alias("alerts"),
    )


def observed(predicted: DataFrame, name: str = "progress") -> DataFrame:
    """Attach per-micro-batch counts, which the query's progress and listeners then carry."""
    return predicted.observe(name, F.count("*").alias("processed"), F.avg("risk_score").alias("mean_score"))


class ObservedTotal(StreamingQueryListener):
    """Adds up a count over all micro-batches of every query it hears of, however many there are."""

    def __init__(self, name: str = "progress", field: str = "processed"):
        self.name, self.field = name, field
        self.totals: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            run = str(event.progress.runId)
            self.totals[run] = self.totals.get(run, 0) + row[self.field]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, query: StreamingQuery, seconds: float = 60.0) -> int:
        """The total of an ended query; its events arrive in order and shortly after it."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the query's end was not reported")
        return self.totals.get(str(query.runId), 0)


def run_and_count(spark: SparkSession, writer, checkpoint: str, name: str = "progress") -> int:
    """:func:`run_all`, returning the rows observed over all its micro-batches."""
    total = ObservedTotal(name)
    spark.streams.addListener(total)
    try:
        return total.of(run_all(writer, checkpoint))
    finally:
        spark.streams.removeListener(total)
