"""The model input matrix: column order, scaling, assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.features import (
    CATEGORICAL_FEATURES,
    ENGINEERED_FEATURES,
    FEATURE_NAMES,
    RAW_FEATURES,
)

NUMERIC = (*RAW_FEATURES, *ENGINEERED_FEATURES)


def feature_matrix(featured: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 36 feature columns as doubles in their fixed order, after the ``keep`` columns."""
    return featured.selectExpr(*keep, *[f"cast({n} as double) as {n}" for n in FEATURE_NAMES])


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [n for n in names if n in have]


def _filled(column: str) -> str:
    return f"coalesce(nanvl(cast({column} as double), 0.0D), 0.0D)"


def fit_scaler(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Mean and population deviation of every numeric column, as one row of structs.

    Deviation 0 is stored as 1, so a constant column scales to 0.
    """
    statistics = [
        f"named_struct('mean', avg({_filled(c)}), 'std', "
        f"case when stddev_pop({_filled(c)}) > 0 then stddev_pop({_filled(c)}) else 1.0D end) as {c}"
        for c in columns
    ]
    return df.agg(*map(F.expr, statistics))


def apply_scaler(
    df: DataFrame,
    scaler: DataFrame,
    keep: Sequence[str] = (),
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> DataFrame:
    """Standardised numeric columns and untouched categories, both with nulls as 0.

    The one-row scaler enters as a scalar subquery: worked out once, then constants in every task.
    """
    stats = scaler.select(F.struct(*scaler.columns)).scalar()
    scaled = [f"({_filled(c)} - _scaler.{c}.mean) / _scaler.{c}.std as {c}" for c in scaler.columns]
    plain = [f"{_filled(c)} as {c}" for c in present(df, categorical)]
    return df.withColumn("_scaler", stats).selectExpr(*keep, *scaled, *plain)


def prepare_train_test(
    train: DataFrame, test: DataFrame, label: str = "is_default", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Both matrices scaled by statistics of the training rows alone."""
    scaler = fit_scaler(train, present(train, NUMERIC))
    kept = (*keep, label)
    return apply_scaler(train, scaler, kept), apply_scaler(test, scaler, kept)


def assemble(matrix: DataFrame, columns: Sequence[str] = FEATURE_NAMES) -> DataFrame:
    """Append the ``features`` vector Spark ML wants; everything before it stays plain columns."""
    names = present(matrix, columns)
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep").transform(matrix)
