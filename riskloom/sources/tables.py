"""Readers and writers for tables, metric files and alert files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.features import BILL_COLUMNS, PAID_COLUMNS, PAY_COLUMNS

# Columns of the labelled credit table.
CREDIT_SCHEMA = T.StructType(
    [T.StructField("ID", T.IntegerType()), T.StructField("LIMIT_BAL", T.DoubleType())]
    + [T.StructField(n, T.IntegerType()) for n in ("SEX", "EDUCATION", "MARRIAGE", "AGE")]
    + [T.StructField(n.upper(), T.IntegerType()) for n in PAY_COLUMNS]
    + [T.StructField(n.upper(), T.DoubleType()) for n in (*BILL_COLUMNS, *PAID_COLUMNS)]
    + [T.StructField("default.payment.next.month", T.IntegerType())]
)
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
        T.StructField("risk_level", T.StringType()),
        T.StructField("model_scores", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("triggered_features", T.ArrayType(T.StringType())),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("credit_limit", T.DoubleType()),
        T.StructField("customer_info", T.StringType()),
        T.StructField("context", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CREDIT_SCHEMA) -> DataFrame:
    """CSV with a header and a declared schema, so no extra pass is spent on inferring types."""
    return spark.read.schema(schema).csv(path, header=True)


def read_train_test(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The pre-split pair ``train.parquet`` and ``test.parquet``."""
    train, test = (read_parquet(spark, f"{folder}/{part}.parquet") for part in ("train", "test"))
    return train, test


def first_rows(df: DataFrame, order: str | Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in an explicit order; Spark keeps only ``n`` rows per task on the way."""
    return df.orderBy(*([order] if isinstance(order, str) else order)).limit(n)


def latest_save(spark: SparkSession, folder: str, prefix: str = "alerts_") -> str | None:
    """Highest-named file or folder starting with ``prefix``; contents are listed, not read."""
    saved = F.regexp_extract("path", f"^(.*/{prefix}[^/]*)", 1)
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return paths.select(saved.alias("save")).filter(F.col("save") != "").agg(F.max("save")).first()[0]


def read_alerts(spark: SparkSession, path: str, array_file: bool = True) -> DataFrame:
    """Alerts from JSON array files, or from JSON lines as :func:`write_alerts` leaves them."""
    return spark.read.schema(ALERT_SCHEMA).json(path, multiLine=array_file)


def read_latest_alerts(spark: SparkSession, folder: str, array_file: bool = True) -> DataFrame:
    """Alerts of the newest save by name; an empty table when there is none."""
    path = latest_save(spark, folder)
    return read_alerts(spark, path, array_file) if path else spark.createDataFrame([], ALERT_SCHEMA)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """Alerts as JSON lines, one part per task."""
    alerts.write.mode("errorifexists").json(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """A metric table as CSV. It has a row per model, so one file is right."""
    metrics.coalesce(1).write.mode("errorifexists").csv(path, header=True)


def write_split(df: DataFrame, label: str, path: str, key: str = "c_custkey") -> None:
    """Features and labels of each part below ``split=``, so a reader of one part skips the other.

    Both keep ``key``, by which they join, and come from one stored table: the split is worked out once.
    """
    df.write.mode("errorifexists").partitionBy("split").parquet(f"{path}/all")
    whole = df.sparkSession.read.parquet(f"{path}/all")
    whole.drop(label).write.mode("errorifexists").partitionBy("split").parquet(f"{path}/features")
    whole.select("split", key, label).write.mode("errorifexists").partitionBy("split").parquet(f"{path}/labels")


def manifest(
    data: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    extras: Mapping[str, Mapping[str, object]] | None = None,
    settings: Mapping[str, int] | None = None,
) -> DataFrame:
    """One nested row describing a training run.

    ``data`` has a ``split`` column with train, validation and test rows. ``extras`` holds small
    per-model maps such as thresholds, cross-validation scores or parameters as text; ``settings``
    are plain numbers such as trials and folds.
    """

    def rows(part: str):
        return F.count_if(F.col("split") == part)

    names = [*numeric, *categorical]
    counted = data.agg(
        rows("train").alias("train_samples"),
        rows("validation").alias("val_samples"),
        rows("test").alias("test_samples"),
        F.avg(F.when(F.col("split") == "train", F.col(label))).alias("default_rate"),
    )
    maps = {
        name: F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
        for name, values in (extras or {}).items()
    }
    return counted.select(
        F.array(*map(F.lit, names)).alias("feature_names"),
        F.lit(len(names)).alias("n_features"),
        F.lit(label).alias("target"),
        F.struct(
            F.array(*map(F.lit, numeric)).alias("numeric_features"),
            F.array(*map(F.lit, categorical)).alias("categorical_features"),
        ).alias("preprocessing"),
        F.struct("train_samples", "val_samples", "test_samples", "default_rate").alias("training_info"),
        *[c.alias(n) for n, c in maps.items()],
        *[F.lit(x).alias(n) for n, x in (settings or {}).items()],
    )


def write_manifest(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("errorifexists").json(path)
