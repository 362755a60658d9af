"""The scoring job: features and model columns in, explained alerts out.

Everything here is a narrow projection or filter, so one scan of the transactions suffices, no row
is shuffled, and the same functions run on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import scoring
from riskloom.params import ScoringParams

ALERT_FIELDS = (
    "alert_id",
    "transaction_id",
    "risk_score",
    "risk_level",
    "model_scores",
    "triggered_features",
    "timestamp",
    "credit_limit",
    "customer_info",
    "context",
)


def predict_scores(df: DataFrame, models: Sequence[str], params: ScoringParams) -> DataFrame:
    """Append risk score, model scores and triggered models of the chosen strategy."""
    columns = {m: F.col(m) for m in models}
    return df.withColumn("prediction", scoring.predict(columns, params)).select(
        *df.columns, "prediction.*"
    )


def build_alerts(predicted: DataFrame, params: ScoringParams) -> DataFrame:
    """Keep scores at or above the alert threshold and shape them as alerts.

    The alert id is derived from the transaction id, so a replayed message gives the same id.
    """
    return (
        predicted.filter(scoring.at_least(F.col("risk_score"), params.alert_threshold))
        .withColumn("risk_level", scoring.risk_level(F.col("risk_score"), params.bounds))
        .select(
            F.expr(_ALERT_ID).alias("alert_id"),
            "transaction_id",
            "risk_score",
            "risk_level",
            "model_scores",
            "triggered_features",
            F.current_timestamp().alias("timestamp"),
            F.col("limit_bal").cast("double").alias("credit_limit"),
            F.concat(F.lit("age_"), F.col("age").cast("string")).alias("customer_info"),
            F.concat(F.lit("edu_"), F.col("education").cast("string")).alias("context"),
        )
    )


_ALERT_ID = (
    "regexp_replace(md5(concat('alert:', transaction_id)),"
    " '(.{8})(.{4})(.{4})(.{4})(.{12})', '$1-$2-$3-$4-$5')"
)


def score_transactions(df: DataFrame, models: Sequence[str], params: ScoringParams) -> DataFrame:
    """Alerts of a table that already has its model columns."""
    return build_alerts(predict_scores(df, models, params), params)
