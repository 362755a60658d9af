"""The periodic report: everything the pipeline says about itself, per window of event time.

Latencies are kept in log-spaced cells, so what a window holds is a few hundred counters per model whatever
its volume, and counters of any parts of it add up. A percentile is the middle of the cell in which the
exact one lies, at most one part in a hundred off. The first grouping, by window and cell, adds up inside
tasks; the second sees only counters. Both work on a table as well as on a stream, where a window's rows leave the state
once the watermark has passed it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scoring import at_least, risk_level, score_bucket
from riskloom.operators.metrics import BUCKETS, percent
from riskloom.params import LEVELS, ScoringParams

#: The largest error of a percentile, relative to the exact one.
ERROR = 0.01
PERCENTILES = {"p50_us": 0.5, "p95_us": 0.95, "p99_us": 0.99}


def growth(error: float = ERROR) -> float:
    """How much wider each cell is than the one before."""
    return (1 + error) / (1 - error)


def latency_cell(us: Column, error: float = ERROR) -> Column:
    """Number of the log-spaced cell of a duration; 0 holds all below one microsecond."""
    cell = F.floor(F.ln(us.cast("double")) / F.lit(math.log(growth(error)))) + 1
    return F.when(us < 1, F.lit(0)).otherwise(cell).cast("int")


def cell_value(cell: Column, error: float = ERROR) -> Column:
    """The value that is equally far, in proportion, from both ends of a cell."""
    g = growth(error)
    return F.when(cell <= 0, F.lit(0.0)).otherwise(F.pow(F.lit(g), cell.cast("double")) * (2 / (g + 1)))


def cell_percentile(cells: Column, p: float, error: float = ERROR) -> Column:
    """The value at 0-based rank ``floor(n * p)`` from counters (cell, n, ...) sorted by cell; null without any."""
    total = F.aggregate(cells, F.lit(0).cast("long"), lambda sum_, c: sum_ + c["n"])
    rank = F.floor(total.cast("double") * F.lit(p)).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("cell"))

    def step(state: Column, c: Column) -> Column:
        seen = state["seen"] + c["n"]
        return F.struct(seen.alias("seen"), F.when(state["cell"].isNull() & (seen > rank), c["cell"]).otherwise(state["cell"]).alias("cell"))

    return F.aggregate(cells, start, step, lambda state: cell_value(state["cell"], error))


def _latency(cells: Column) -> Column:
    """Calls, integer mean, percentiles and maximum of sorted counters."""
    add = lambda name: F.aggregate(cells, F.lit(0).cast("long"), lambda total, c: total + c[name])
    calls = add("n")
    return F.struct(
        calls.alias("calls"),
        F.call_function("div", add("us"), F.when(calls > 0, calls)).alias("mean_us"),
        *[cell_percentile(cells, p).alias(name) for name, p in PERCENTILES.items()],
        F.aggregate(cells, F.lit(None).cast("long"), lambda most, c: F.greatest(most, c["most"])).alias("max_us"),
    )


def full_report(
    scored: DataFrame,
    ts: str = "ts",
    seconds: int = 30,
    params: ScoringParams = ScoringParams(),
    score: str = "risk_score",
    duration: str = "duration_us",
    agreement: str = "agreement",
    model_times: str | None = "model_us",
) -> DataFrame:
    """One row per tumbling window: volume, alerts by level, score tenths, latency, agreement, and each model's latency.

    ``model_times`` is a map from model to microseconds, null if none was called. Durations and model times are whole
    and not negative; null ones are left out of latencies. Rows without a time belong to no window. On a stream, set the watermark on ``ts`` before,
    write in append mode, and add no aggregation behind it.
    """
    width = f"{seconds} seconds"
    own = F.struct(F.lit(None).cast("string").alias("model"), F.col(duration).cast("long").alias("us"))
    calls = F.array(own)
    if model_times:
        each = F.transform(F.map_entries(model_times), lambda e: F.struct(e["key"].alias("model"), e["value"].cast("long").alias("us")))
        calls = F.concat(calls, F.coalesce(F.filter(each, lambda c: c["us"].isNotNull()), F.array().cast("array<struct<model:string,us:bigint>>")))
    rows = scored.filter(F.col(ts).isNotNull()).select(
        ts, F.col(score).alias("_score"), F.col(agreement).alias("_agreement"), F.explode(calls).alias("_call")
    )
    row = F.col("_call.model").isNull()  # one call stands for the transaction itself
    alert = row & at_least(F.col("_score"), params.alert_threshold)
    level, tenth = risk_level(F.col("_score"), params.bounds), score_bucket(F.col("_score"))
    counters = rows.groupBy(
        F.window(ts, width).alias("window"), F.col("_call.model").alias("model"), latency_cell(F.col("_call.us")).alias("cell")
    ).agg(
        F.count("*").alias("n"),
        F.sum("_call.us").alias("us"),
        F.max("_call.us").alias("most"),
        F.count_if(alert).alias("alerts"),
        *[F.count_if(alert & (level == name)).alias(f"level_{name}") for name in LEVELS],
        *[F.count_if(row & (tenth == b)).alias(f"bucket_{b}") for b in range(BUCKETS)],
        F.sum(F.when(row, F.col("_agreement"))).alias("agreement"),
        F.count(F.when(row, F.col("_agreement"))).alias("agreed"),
    )
    counter = F.struct("model", "cell", "n", "us", "most")
    whole = counters.groupBy(F.window(F.window_time("window"), width).alias("window")).agg(
        F.sum(F.when(F.col("model").isNull(), F.col("n"))).alias("processed"),
        F.sum("alerts").alias("alerts"),
        *[F.sum(f"level_{name}").alias(f"level_{name}") for name in LEVELS],
        *[F.sum(f"bucket_{b}").alias(f"bucket_{b}") for b in range(BUCKETS)],
        F.sum("agreement").alias("agreement"),
        F.sum("agreed").alias("agreed"),
        # Bounded: a counter per cell and model.
        F.array_sort(F.collect_list(counter)).alias("cells"),
    )
    timed = F.filter("cells", lambda c: c["model"].isNull() & c["cell"].isNotNull())
    models = F.array_distinct(F.transform(F.filter("cells", lambda c: c["model"].isNotNull()), lambda c: c["model"]))
    of_model = F.transform(
        models,
        lambda m: F.struct(m.alias("model"), _latency(F.filter("cells", lambda c: c["model"] == m)).alias("latency")),
    )
    report = whole.withColumns({"_latency": _latency(timed), "models": of_model})
    return report.select(
        F.col("window.start").alias("window_start"),
        "processed",
        "alerts",
        percent(F.col("alerts"), F.col("processed")).alias("alert_rate"),
        (F.col("processed") / F.lit(float(seconds))).alias("per_second"),
        *[F.col(f"_latency.{c}").alias(c) for c in ("mean_us", *PERCENTILES, "max_us")],
        F.try_divide(F.col("agreement"), F.col("agreed").cast("double")).alias("avg_agreement"),
        *[F.col(f"level_{name}") for name in LEVELS],
        F.array(*[f"bucket_{b}" for b in range(BUCKETS)]).alias("score_buckets"),
        F.transform("models", lambda m: F.struct(m["model"].alias("model"), m["latency"]["calls"].alias("calls"), *[m["latency"][c].alias(c) for c in ("mean_us", *PERCENTILES)])).alias("models"),
    )
