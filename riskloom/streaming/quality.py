"""Alerts against labels while both arrive: the stream form of joining labels with their alerts.

Labels come early or late, alerts may be repeated by their sink, and most labels have none. Alerts of one
transaction are gathered in sessions, so that a repeat counts once and the last one wins, and labels are then
left-joined with them inside bounds of event time. Watermarks on both sides close sessions, tell that no alert
will come, and let both sides leave the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labels_with_alerts(
    labels: DataFrame,
    alerts: DataFrame,
    key: str = "transaction_id",
    ts: str = "ts",
    delay: str = "10 minutes",
    repeats: str = "5 minutes",
    early: str = "1 hour",
    late: str = "1 hour",
) -> DataFrame:
    """Every label once, with its last alert as ``alert`` or null, and ``predicted_score`` and ``has_alert``.

    Both streams have the key and an event time ``ts``; alerts have ``risk_score``. Rows come up to ``delay`` out of order,
    repeats of an alert within ``repeats`` of each other, and an alert is a label's if it is not more than ``early``
    before or ``late`` after it. Rows without a key match nothing, and without a time are not read. A stream's last rows
    are held back until both streams have gone on far enough.
    """
    told = labels.filter(F.col(ts).isNotNull()).withWatermark(ts, delay)
    names = [c for c in alerts.columns if c != key]
    last = (
        alerts.filter(F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        # No key stays a key here: a condition on it would be pushed below the watermark and hide the row's time from it.
        .groupBy(F.coalesce(F.col(key), F.lit("")).alias("alert_key"), F.session_window(ts, repeats).alias("session"))
        .agg(F.max_by(F.struct(*names), F.struct(ts, "risk_score")).alias("alert"))
        .select("alert_key", F.window_time("session").alias("alert_ts"), "alert")
    )
    near = (
        (F.col(key) == F.col("alert_key"))
        & (F.col("alert_ts") >= F.col(ts) - F.expr(f"interval {early}"))
        & (F.col("alert_ts") <= F.col(ts) + F.expr(f"interval {late}") + F.expr(f"interval {repeats}"))
    )
    joined = told.join(last, near, "left_outer")
    return joined.select(
        *labels.columns,
        "alert",
        F.coalesce("alert.risk_score", F.lit(0.0)).alias("predicted_score"),
        F.col("alert").isNotNull().alias("has_alert"),
    )
