"""Derived tables: a credit profile per customer and the scores built on it.

The same definitions exist as SQL text in :mod:`riskloom.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.functions import features, scoring
from riskloom.functions.features import BILL_COLUMNS, PAID_COLUMNS, PAY_COLUMNS
from riskloom.operators.ensemble import to_long
from riskloom.params import MODELS, ScoringParams
from riskloom.plans.scoring import score_transactions
from riskloom.session import discard, work_dir
from riskloom.sources.tables import table

STATEMENTS = 6


def credit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: limit, demographics, six statements, and a synthetic label.

    The latest six orders are kept per customer *before* their lines are joined. Spark trims each
    map task to six rows per customer ahead of the shuffle, so a customer with very many orders
    costs no more than any other.
    """
    latest = W.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    statements = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
        .withColumn("m", F.row_number().over(latest))
        .filter(F.col("m") <= STATEMENTS)
    )
    paid = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            # Prices and discounts have two decimals, so four make the sum independent of its order.
            F.round(F.sum(F.col("l_extendedprice") * (1.0 - F.col("l_discount"))), 4).alias("paid"),
            F.max("l_shipdate").alias("last_ship"),
        )
    )
    years = F.floor(F.datediff("last_ship", "o_orderdate") / F.lit(365.0))
    joined = statements.join(paid, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_custkey",
        "m",
        F.col("o_totalprice").alias("bill"),
        F.coalesce("paid", F.lit(0.0)).alias("paid"),
        F.when(F.col("l_orderkey").isNull(), F.lit(-1))
        .otherwise(F.least(F.greatest(years, F.lit(-2)), F.lit(8)))
        .cast("int")
        .alias("status"),
    )

    wide = joined.groupBy("o_custkey").agg(
        *[
            F.expr(f"max(case when m = {m} then {value} end) as {name}")
            for value, names in (("status", PAY_COLUMNS), ("bill", BILL_COLUMNS), ("paid", PAID_COLUMNS))
            for m, name in enumerate(names, 1)
        ]
    )
    key = F.col("c_custkey")
    profile = (
        table(spark, sf_dir, "customer")
        .join(wide, key == F.col("o_custkey"), "left")
        .select(
            "c_custkey",
            (F.lit(50000.0) + F.greatest("c_acctbal", F.lit(0.0)) * 45.0).alias("limit_bal"),
            (key % 2 + 1).cast("int").alias("sex"),
            (key % 7).cast("int").alias("education"),
            (key % 4).cast("int").alias("marriage"),
            (key * 7 % 85 + 21).cast("int").alias("age"),
            *[F.expr(f"coalesce({n}, 0) as {n}") for n in PAY_COLUMNS],
            *[F.expr(f"coalesce({n}, 0.0D) as {n}") for n in (*BILL_COLUMNS, *PAID_COLUMNS)],
        )
    )
    late = (F.col("pay_0") + F.col("pay_2") >= 5) & (key % 4 != 0)
    return profile.withColumn("is_default", (late | (key % 11 == 0)).cast("int"))


def featured_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_features(credit_profile(spark, sf_dir))


def model_scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured profile with one probability column per stand-in model, null where it failed."""
    return with_scorecards(featured_profile(spark, sf_dir))


def with_scorecards(featured: DataFrame) -> DataFrame:
    columns = {m: scoring.scorecard(m) for m in MODELS}
    failed = F.col("c_custkey") % 37 == 5
    columns["lightgbm"] = F.when(~failed, columns["lightgbm"])
    return featured.withColumns(columns)


def labelled_scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, label, limit and model columns; failed models stay null."""
    return model_scores_wide(spark, sf_dir).select(
        F.col("c_custkey").alias("id"), F.col("is_default").alias("label"), "limit_bal", *MODELS
    )


def model_scores(spark: SparkSession, sf_dir: str, with_ensemble: bool = False) -> DataFrame:
    """Long form ``(id, label, model, score)``; a failed model keeps its row with a null score."""
    wide = labelled_scores_wide(spark, sf_dir)
    names = list(MODELS)
    if with_ensemble:
        params = ScoringParams()
        filled = scoring.neutral_if_failed({m: F.col(m) for m in MODELS})
        wide = wide.withColumn("ensemble", scoring.weighted_mean(filled, params.weights))
        names.append("ensemble")
    return to_long(wide, names, ["id", "label"])


def evaluated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scores of the models and the ensemble, failed ones neutral, as evaluation sees them.

    Eight decimals, so that equal scores stay equal whichever library worked out the exponential.
    """
    return model_scores(spark, sf_dir, with_ensemble=True).withColumn(
        "score", F.round(F.coalesce("score", F.lit(0.5)), 8)
    )


def alerts(spark: SparkSession, sf_dir: str, params: ScoringParams | None = None) -> DataFrame:
    """Alerts of the whole profile under the ensemble strategy."""
    params = params or ScoringParams()
    transactions = model_scores_wide(spark, sf_dir).withColumn(
        "transaction_id", F.col("c_custkey").cast("string")
    )
    return score_transactions(transactions, MODELS, params)


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality labels with a coarse score, so that many rows tie."""
    z = -(F.col("n_chars") - F.lit(3000.0)) / F.lit(4000.0)
    return (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(
            F.col("doc_id").alias("id"),
            F.col("quality").alias("label"),
            F.lit("length").alias("model"),
            F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(z)), 2).alias("score"),
        )
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations in microseconds taken from events, in arrival order."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("model"),
        F.floor(F.col("value") * 100.0).cast("long").alias("duration_us"),
    )


def transaction_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as JSON messages: both spellings, and five kinds of broken ones."""
    from riskloom.sources.wire import FIELD_ALIASES, to_transaction_json

    profile = credit_profile(spark, sf_dir).withColumnRenamed("c_custkey", "ID")
    sent = profile.select("ID", to_transaction_json("ID").alias("plain"))
    plain = F.col("plain")
    upper = "plain"
    for name, alias in FIELD_ALIASES.items():
        upper = f"""replace({upper}, '"{name}":', '"{alias}":')"""
    spelled = F.when(F.col("ID") % 2 == 0, F.expr(upper)).otherwise(plain)
    kind = F.col("ID") % 50
    broken = (
        F.when(kind == 0, F.expr("substring(spelled, 1, length(spelled) - 10)"))
        .when(kind == 1, F.regexp_replace("spelled", '"(age|AGE)":(\\d+)', '"$1":"$2"'))
        .when(kind == 2, F.regexp_replace("spelled", '"(limit_bal|LIMIT_BAL)":[^,]+,', ""))
        .when(kind == 3, F.regexp_replace("spelled", '"(transaction_id|ID)":"(\\d+)"', '"$1":$2'))
        .when(kind == 4, F.regexp_replace("spelled", "^\\{", '{"age":30,'))
        .otherwise(F.col("spelled"))
    )
    return sent.withColumn("spelled", spelled).select(
        F.col("ID").alias("id"), broken.alias("value")
    )


def arrivals(
    spark: SparkSession, events: DataFrame, folder: str, batches: int = 6, late_seconds: int = 600
) -> StructType:
    """Write events as ``batches`` Parquet files in order of arrival, which is up to ``late_seconds`` after ``ts``.

    Inside a file and between neighbouring ones, events are out of order. A last file has one row with
    nothing but a time, far enough ahead for everything before it to be complete. Returns the schema to read with.

    The events are worked out once, by as many tasks as they take, and kept until their files are written.
    """
    kept = work_dir(spark, "arriving")
    events.write.parquet(kept)
    events = spark.read.schema(events.schema).parquet(kept)
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    arrived = events.withColumn("_arrived", seconds + F.pmod(F.xxhash64(*events.columns), F.lit(late_seconds)))
    first, last = arrived.agg(F.min("_arrived"), F.max("_arrived")).head()
    width = (last - first) / batches if last is not None else 1.0
    for i in range(batches):
        low, high = (first or 0) + i * width, (first or 0) + (i + 1) * width
        inside = (F.col("_arrived") >= low) & ((F.col("_arrived") < high) | F.lit(i == batches - 1))
        arrived.filter(inside).drop("_arrived").coalesce(1).write.mode("append").parquet(folder)
    ahead = events.agg((F.max("ts").cast("timestamp") + F.expr("interval 30 days")).alias("ts"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != "ts" else F.col("ts").cast(f.dataType) for f in events.schema]
    ahead.select(*nothing).write.mode("append").parquet(folder)
    discard(spark, kept)
    return events.schema
