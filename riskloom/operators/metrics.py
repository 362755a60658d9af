"""Running statistics of the scoring job: counts, latencies, histograms, alert levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskloom.functions.scoring import at_least, score_bucket
from riskloom.operators.evaluation import ratio
from riskloom.operators.running import value_at, value_counts
from riskloom.params import HISTORY_CAPS

BUCKETS = 10


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100.0


def processed_and_alerts(predicted: DataFrame, threshold: float, score: str = "risk_score") -> DataFrame:
    """Rows scored, alerts among them, and the alert rate in percent."""
    counted = predicted.agg(
        F.count("*").alias("processed"),
        F.count_if(at_least(F.col(score), threshold)).alias("alerts"),
    )
    return counted.withColumn("alert_rate", percent(F.col("alerts"), F.col("processed")))


def nearest_rank(p: float, n: Column) -> Column:
    """0-based rank ``floor(n * p)`` of the sorted list."""
    return F.floor(n.cast("double") * F.lit(p)).cast("long")


def latency_stats(
    durations: DataFrame, keys: Sequence[str] = (), value: str = "duration_us"
) -> DataFrame:
    """Count, integer mean, p50, p95, p99 and maximum, exact, per key combination.

    One row always comes back when there are no keys; it is all zero for an empty table.
    """
    counts = value_counts(durations, keys, value)
    n = F.col("all_n")
    rows = F.sum("n")
    # Whole numbers throughout: a double would be inexact above 2^53, a long sum could overflow.
    mean = F.coalesce(F.expr(f"sum(cast({value} as decimal(38, 0)) * n) div nullif(sum(n), 0)"), F.lit(0))
    columns = [
        F.coalesce(rows, F.lit(0)).alias("calls"),
        mean.alias("mean_us"),
        *[
            F.coalesce(value_at(nearest_rank(p, n), value), F.lit(0)).alias(name)
            for name, p in (("p50_us", 0.5), ("p95_us", 0.95), ("p99_us", 0.99))
        ],
        F.coalesce(F.max(value), F.lit(0)).alias("max_us"),
    ]
    return counts.groupBy(*keys).agg(*columns) if keys else counts.agg(*columns)


def retained(n: Column, cap: int) -> Column:
    """How many of ``n`` pushes a list keeps that drops its oldest half of ``cap`` when over it."""
    half = cap // 2
    return F.when(n <= cap, n).otherwise((n - cap - 1) % half + half + 1)


def recent_history(
    df: DataFrame, order: Sequence[str], kind: str = "processing", keys: Sequence[str] = ()
) -> DataFrame:
    """The rows a bounded history still holds after all rows were pushed in ``order``.

    ``order`` starts with a timestamp. Without keys, the newest rows of each task are all that meet.
    With keys, rows are first counted per minute; only the latest minutes that together hold the cap
    can matter, so the window is left with little more than the cap per key.
    """
    cap = HISTORY_CAPS[kind]
    if not keys:
        # Every task keeps its own newest rows, so what meets in one place is bounded by the cap.
        pushed = df.agg(F.count("*").alias("n")).scalar()
        newest = df.orderBy(*[F.desc(c) for c in order]).limit(cap)
        aged = newest.withColumn("_age", F.row_number().over(W.partitionBy().orderBy(*[F.desc(c) for c in order])))
        return aged.filter(F.col("_age") <= retained(pushed, cap)).select(*df.columns)
    group = list(keys)
    data = df.withColumn("_minute", F.date_trunc("minute", F.col(order[0]).cast("timestamp")))
    minutes = data.groupBy(*group, "_minute").agg(F.count("*").alias("n"))
    later = W.partitionBy(*group).orderBy(F.desc("_minute")).rowsBetween(W.unboundedPreceding, -1)
    reach = (
        minutes.withColumn("_later", F.coalesce(F.sum("n").over(later), F.lit(0)))
        .groupBy(*group)
        .agg(
            F.sum("n").alias("_pushed"),
            F.min(F.when(F.col("_later") < cap, F.col("_minute"))).alias("_from"),
        )
    )
    newest = W.partitionBy(*group).orderBy(*[F.desc(c) for c in order])
    recent = data.join(reach, group).filter(F.col("_minute") >= F.col("_from"))
    return (
        recent.withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= cap)
        .filter(F.col("_age") <= retained(F.col("_pushed"), cap))
        .select(*df.columns)
    )


def average_agreement(agreements: DataFrame, column: str = "agreement") -> DataFrame:
    """Mean over the rows that have an agreement, 0 when none has."""
    return agreements.agg(F.coalesce(F.avg(column), F.lit(0.0)).alias("avg_agreement"))


def elapsed_seconds(ts: str) -> Column:
    start, end = F.min(ts).cast("timestamp"), F.max(ts).cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def throughput(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows per second between the first and the last one, 0 when no time passed."""
    return events.agg(ratio(F.count("*"), elapsed_seconds(ts)).alias("per_second"))


def score_histogram(predicted: DataFrame, score: str = "risk_score") -> DataFrame:
    """Rows per tenth of the unit interval, empty tenths included, with their share in percent."""
    counts = predicted.groupBy(score_bucket(F.col(score)).alias("bucket")).agg(F.count("*").alias("n"))
    buckets = predicted.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    # Ten rows from here on.
    filled = counts.join(buckets, "bucket", "right").fillna(0, ["n"])
    total = F.sum("n").over(W.partitionBy())
    return filled.withColumn("pct", percent(F.col("n"), total))


def alerts_by_level(alerts: DataFrame) -> DataFrame:
    """Alerts per level with their share in percent; four rows at most are left to divide."""
    counts = alerts.groupBy("risk_level").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(W.partitionBy())))


def alert_score_stats(alerts: DataFrame, score: str = "risk_score") -> DataFrame:
    """Minimum, maximum, mean and upper median of the alert scores."""
    return value_counts(alerts, [], score).agg(
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.try_divide(F.sum(F.col(score) * F.col("n")), F.sum("n")).alias("mean_score"),
        value_at(F.floor(F.col("all_n") / 2), score).alias("median_score"),
    )


def pipeline_summary(
    predicted: DataFrame, durations: DataFrame, threshold: float, ts: str = "ts"
) -> DataFrame:
    """One row with volume, alert rate, throughput, latency and agreement.

    ``predicted`` has ``risk_score`` and ``agreement``. The parts are one-row tables, attached as
    scalar subqueries.
    """
    volume = predicted.agg(
        F.count("*").alias("processed"),
        F.count_if(at_least(F.col("risk_score"), threshold)).alias("alerts"),
        F.coalesce(F.avg("agreement"), F.lit(0.0)).alias("avg_agreement"),
    )
    latency = latency_stats(durations)
    rate = throughput(durations, ts)
    with_parts = volume.withColumns(
        {
            "latency": latency.select(F.struct(*latency.columns)).scalar(),
            "per_second": rate.scalar(),
        }
    )
    return with_parts.select(
        "processed",
        "alerts",
        percent(F.col("alerts"), F.col("processed")).alias("alert_rate"),
        "per_second",
        *[F.col(f"latency.{c}").alias(c) for c in latency.columns if c != "calls"],
        "avg_agreement",
    )


def report_windows(
    scored: DataFrame, ts: str = "ts", seconds: int = 30, threshold: float = 0.56, score: str = "risk_score"
) -> DataFrame:
    """Volume and alerts per tumbling event-time window; works on a stream with a watermark too."""
    return (
        scored.groupBy(F.window(ts, f"{seconds} seconds").alias("window"))
        .agg(
            F.count("*").alias("processed"),
            F.count_if(at_least(F.col(score), threshold)).alias("alerts"),
            F.avg(score).alias("mean_score"),
        )
        .select(
            F.col("window.start").alias("window_start"), "processed", "alerts", "mean_score"
        )
    )


# --- anomaly scores -----------------------------------------------------------------------------


def anomaly_probability(df: DataFrame, raw: str, bounds: DataFrame | None = None) -> DataFrame:
    """Inverted min-max of a raw score where low means anomalous; 0 when all are equal.

    ``bounds`` is a one-row table ``lowest, highest``. Without it the batch's own are used, as
    :func:`anomaly_bounds` gives them; a stream passes the bounds frozen at fit time.
    """
    one = bounds if bounds is not None else anomaly_bounds(df, raw)
    edges = one.select(F.struct("lowest", "highest")).scalar()
    span = F.col("_edges.highest") - F.col("_edges.lowest")
    scaled = F.lit(1.0) - (F.col(raw) - F.col("_edges.lowest")) / span
    return (
        df.withColumn("_edges", edges)
        .withColumn("anomaly_score", F.when(span > 0, scaled).otherwise(0.0))
        .drop("_edges")
    )


def anomaly_bounds(df: DataFrame, raw: str) -> DataFrame:
    return df.agg(F.min(raw).alias("lowest"), F.max(raw).alias("highest"))


def exact_quantile(df: DataFrame, value: str, q: Column | float) -> DataFrame:
    """Linearly interpolated quantile of all rows as one row ``cutoff``."""
    share = q if isinstance(q, Column) else F.lit(q)
    position = (F.col("all_n") - 1).cast("double") * share
    below = F.floor(position)
    counted = value_counts(df, [], value).agg(
        value_at(below, value).alias("low"),
        value_at(F.ceil(position), value).alias("high"),
        F.max(position - below).alias("part"),
    )
    return counted.select((F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("cutoff"))


def anomaly_flag(
    df: DataFrame, raw: str, train: DataFrame, contamination: Column | float
) -> DataFrame:
    """1 strictly below the training rows' ``contamination`` quantile of the raw score."""
    cutoff = exact_quantile(train, raw, contamination).scalar()
    return df.withColumn("is_anomaly", (F.col(raw) < cutoff).cast("int"))
