"""The bounded recent history as keyed state: what the last calls of a key took, and their statistics.

A list takes every push and drops its oldest half of ``cap`` when it grows over ``cap``, so a push costs a
constant in the mean and a key never holds more than ``cap`` entries between micro-batches. The list can be
read from the checkpoint with Spark's state reader; what the stream itself gives is each key's statistics after
every micro-batch in which it was called.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.session import ship_package
from riskloom.streaming.velocity import use_rocksdb

_STATS = "key string, pushed long, calls long, mean_us long, p50_us long, p95_us long, p99_us long, max_us long"


def kept_entries(pushed: int, cap: int) -> int:
    """How many entries are left after so many pushes; half of ``cap`` goes whenever there is one too many."""
    half = cap // 2
    return pushed if pushed <= cap else (pushed - cap - 1) % half + cap - half + 1


class RecentHistory(StatefulProcessor):
    def __init__(self, cap: int):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getListState("history", "id string, us long")
        self.pushed = handle.getValueState("pushed", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for frame in rows:
            new += zip(frame["t"].tolist(), frame["id"].tolist(), frame["us"].tolist())
        new = [(name, us) for _, name, us in sorted(new, key=lambda e: (e[0], len(e[1]), e[1]))]
        held = [tuple(e) for e in self.history.get()] if self.history.exists() else []
        pushed = (self.pushed.get()[0] if self.pushed.exists() else 0) + len(new)
        left = (held + new)[-kept_entries(pushed, self.cap) :]
        if len(left) == len(held) + len(new):
            self.history.appendList(new)
        else:
            self.history.put(left)
        self.pushed.update((pushed,))
        times = sorted(us for _, us in left)
        n = len(times)
        stats = [sum(times) // n, *(times[int(n * p)] for p in (0.5, 0.95, 0.99)), times[-1]]
        yield pd.DataFrame([[key[0], pushed, n, *stats]], columns=[c.split()[0] for c in _STATS.split(", ")])

    def close(self) -> None:
        pass


def recent_history_stream(
    calls: DataFrame, cap: int, key: str = "model", ts: str = "ts", call_id: str = "event_id", us: str = "duration_us"
) -> DataFrame:
    """(key, pushed, calls, mean_us, p50_us, p95_us, p99_us, max_us) of a key's history, in update mode.

    Calls are pushed in the order of micro-batches, and inside one by time and id. Calls with a null in any of
    the four columns are left out.
    """
    use_rocksdb(calls.sparkSession)
    ship_package(calls.sparkSession)
    rows = calls.select(
        F.col(key).cast("string").alias("key"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("t"),
        F.col(call_id).cast("string").alias("id"),
        F.col(us).cast("long").alias("us"),
    ).na.drop()
    return rows.groupBy("key").transformWithStateInPandas(
        RecentHistory(cap), outputStructType=_STATS, outputMode="Update", timeMode="None"
    )


def read_history(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, id, us): the entries that a stopped stream's keys hold."""
    state = spark.read.format("statestore").option("stateVarName", "history").option("flattenCollectionTypes", True)
    return state.load(checkpoint).select("key.key", "list_element.id", "list_element.us")
