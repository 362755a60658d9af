"""Cleaning, projection and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scoring import at_least

# Column renames, and category codes folded into "other".
RENAMES = {"PAY_0": "PAY_1", "default.payment.next.month": "default"}
EDUCATION_OTHER = (0, 5, 6)
EDUCATION_INTO = 4
MARRIAGE_OTHER = (0,)
MARRIAGE_INTO = 3


def rename_and_drop(
    df: DataFrame, renames: Mapping[str, str] = RENAMES, drop: Sequence[str] = ("ID",)
) -> DataFrame:
    return df.withColumnsRenamed(dict(renames)).drop(*drop)


def recode_education(column: str = "education") -> Column:
    code = F.col(column)
    return F.when(code.isin(*EDUCATION_OTHER), EDUCATION_INTO).otherwise(code)


def recode_marriage(column: str = "marriage") -> Column:
    code = F.col(column)
    return F.when(code.isin(*MARRIAGE_OTHER), MARRIAGE_INTO).otherwise(code)


def clean_categories(df: DataFrame) -> DataFrame:
    return df.withColumns({"education": recode_education(), "marriage": recode_marriage()})


def fill_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN become 0. Training does this after the features are built, never before."""
    return df.fillna(0, subset=list(columns))


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Category codes passed through as numbers."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})


def normal_only(df: DataFrame, label: str = "is_default") -> DataFrame:
    return df.filter(F.col(label) == 0)


def alerts_only(df: DataFrame, threshold: float, score: str = "risk_score") -> DataFrame:
    return df.filter(at_least(F.col(score), threshold))


def binarise(score: Column, threshold: Column | float) -> Column:
    """1 at or above the threshold, else 0; NaN and null are 0."""
    return at_least(score, threshold).cast("int")


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns the table has, in the wanted order."""
    have = {c.lower() for c in df.columns}
    return df.select(*[c for c in wanted if c.lower() in have])
