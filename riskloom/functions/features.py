"""Credit behaviour features as plain column expressions.

Column names resolve case-insensitively, so the same expressions serve ``pay_0`` and ``PAY_0``.
Scripts that renamed the first status to ``pay_1`` pass their own ``pays``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Input columns, the engineered names and their order in the vector.
PAY_COLUMNS = ("pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6")
RENAMED_PAY_COLUMNS = ("pay_1", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6")
BILL_COLUMNS = ("bill_amt1", "bill_amt2", "bill_amt3", "bill_amt4", "bill_amt5", "bill_amt6")
PAID_COLUMNS = ("pay_amt1", "pay_amt2", "pay_amt3", "pay_amt4", "pay_amt5", "pay_amt6")
RAW_FEATURES = ("limit_bal", "age", *PAY_COLUMNS, *BILL_COLUMNS, *PAID_COLUMNS)
ENGINEERED_FEATURES = (
    "avg_pay_delay",
    "max_pay_delay",
    "months_delayed",
    "pay_trend",
    "avg_bill_amt",
    "bill_trend",
    "bill_volatility",
    "avg_pay_amt",
    "total_pay_amt",
    "utilization_ratio",
    "over_limit",
    "pay_bill_ratio",
    "age_group",
)
CATEGORICAL_FEATURES = ("sex", "education", "marriage")
FEATURE_NAMES = (*RAW_FEATURES, *ENGINEERED_FEATURES, *CATEGORICAL_FEATURES)
SUMMARY_FEATURES = (
    "times_late",
    "max_months_late",
    "avg_bill",
    "avg_payment",
    "payment_ratio",
    "credit_util",
)
AGE_POLICIES = ("serving", "training", "scripts", "r")


# Sums across columns are written as SQL text: one expression to build instead of dozens.


def _sum(terms: Sequence[str]) -> str:
    return "(" + " + ".join(terms) + ")"


def _row_sum(names: Sequence[str]) -> str:
    return _sum([f"coalesce(cast({n} as double), 0.0D)" for n in names])


def _present(names: Sequence[str]) -> str:
    return _sum([f"cast({n} is not null as int)" for n in names])


def _row_mean(names: Sequence[str]) -> str:
    return f"({_row_sum(names)} / nullif({_present(names)}, 0))"


def row_sum(names: Sequence[str]) -> Column:
    """Sum across columns, missing entries counting nothing."""
    return F.expr(_row_sum(names))


def row_mean(names: Sequence[str]) -> Column:
    """Mean of the entries that are present; null when none is."""
    return F.expr(_row_mean(names))


def row_std(names: Sequence[str], ddof: int) -> Column:
    """Deviation of the entries that are present, dividing by their number less ``ddof``."""
    mean = _row_mean(names)
    squares = _sum([f"coalesce(pow({n} - {mean}, 2.0D), 0.0D)" for n in names])
    divisor = f"({_present(names)} - {ddof})"
    return F.expr(f"case when {divisor} > 0 then sqrt({squares} / {divisor}) end")


def avg_pay_delay(pays: Sequence[str] = PAY_COLUMNS) -> Column:
    return row_mean(pays)


def max_pay_delay(pays: Sequence[str] = PAY_COLUMNS) -> Column:
    return F.greatest(*[F.col(n) for n in pays])


def months_delayed(pays: Sequence[str] = PAY_COLUMNS) -> Column:
    return F.expr(_sum([f"coalesce(cast({n} > 0 as int), 0)" for n in pays]))


def pay_trend(pays: Sequence[str] = PAY_COLUMNS) -> Column:
    return F.col(pays[0]) - F.col(pays[-1])


def avg_bill_amt() -> Column:
    return row_mean(BILL_COLUMNS)


def bill_trend() -> Column:
    return F.col(BILL_COLUMNS[0]) - F.col(BILL_COLUMNS[-1])


def bill_volatility(ddof: int = 1) -> Column:
    """``ddof=1`` is what training uses, ``ddof=0`` what serving uses."""
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 or 1")
    return row_std(BILL_COLUMNS, ddof)


def avg_pay_amt() -> Column:
    return row_mean(PAID_COLUMNS)


def total_pay_amt() -> Column:
    return row_sum(PAID_COLUMNS)


def utilization_ratio() -> Column:
    # A limit of -1 has no ratio; try_divide keeps such a row instead of failing the job.
    return F.try_divide(F.col("bill_amt1").cast("double"), F.col("limit_bal") + F.lit(1.0))


def over_limit() -> Column:
    return F.coalesce((F.col("bill_amt1") > F.col("limit_bal")).cast("int"), F.lit(0))


def pay_bill_ratio() -> Column:
    return F.col("pay_amt1") / (F.abs(F.col("bill_amt1")) + F.lit(1.0))


def age_group(policy: str = "training") -> Column:
    """Age bin 0..4. The policies differ only outside the bins."""
    if policy not in AGE_POLICIES:
        raise ValueError(f"unknown age policy: {policy}")
    age = F.col("age")
    lowest, highest, otherwise = {
        "serving": (age.between(0, 25), F.lit(False), 4),
        "training": ((age > 0) & (age <= 25), (age > 55) & (age <= 100), 0),
        "scripts": ((age > 0) & (age <= 25), (age > 55) & (age <= 100), 2),
        "r": (age <= 25, F.lit(False), 4),
    }[policy]
    return (
        F.when(lowest, 0)
        .when((age > 25) & (age <= 35), 1)
        .when((age > 35) & (age <= 45), 2)
        .when((age > 45) & (age <= 55), 3)
        .when(highest, 4)
        .otherwise(otherwise)
    )


def engineered(
    pays: Sequence[str] = PAY_COLUMNS, ddof: int = 1, age_policy: str = "training"
) -> dict[str, Column]:
    """The thirteen engineered features by name, in vector order."""
    built = (
        avg_pay_delay(pays),
        max_pay_delay(pays),
        months_delayed(pays),
        pay_trend(pays),
        avg_bill_amt(),
        bill_trend(),
        bill_volatility(ddof),
        avg_pay_amt(),
        total_pay_amt(),
        utilization_ratio(),
        over_limit(),
        pay_bill_ratio(),
        age_group(age_policy),
    )
    return dict(zip(ENGINEERED_FEATURES, built, strict=True))


def _requirements(pays: Sequence[str]) -> dict[str, tuple[str, ...]]:
    status = {n: tuple(pays) for n in ENGINEERED_FEATURES[:4]}
    bills = {n: BILL_COLUMNS for n in ENGINEERED_FEATURES[4:7]}
    paid = {n: PAID_COLUMNS for n in ENGINEERED_FEATURES[7:9]}
    return {
        **status,
        **bills,
        **paid,
        "utilization_ratio": ("limit_bal", "bill_amt1"),
        "over_limit": ("limit_bal", "bill_amt1"),
        "pay_bill_ratio": ("pay_amt1", "bill_amt1"),
        "age_group": ("age",),
    }


def add_features(
    df: DataFrame,
    pays: Sequence[str] = PAY_COLUMNS,
    ddof: int = 1,
    age_policy: str = "training",
) -> DataFrame:
    """Append every engineered feature whose input columns the table has."""
    have = {c.lower() for c in df.columns}
    needs = _requirements(pays)
    columns = engineered(pays, ddof, age_policy)
    return df.withColumns({n: c for n, c in columns.items() if set(needs[n]) <= have})


def add_serving_features(df: DataFrame) -> DataFrame:
    """Features as the online path computes them: population deviation, open age bins."""
    return add_features(df, ddof=0, age_policy="serving")


def add_summary_features(df: DataFrame, pays: Sequence[str] = RENAMED_PAY_COLUMNS) -> DataFrame:
    """The shorter feature set: lateness, averages and two ratios."""
    return df.withColumns(
        {
            "times_late": months_delayed(pays),
            "max_months_late": max_pay_delay(pays),
            "avg_bill": avg_bill_amt(),
            "avg_payment": avg_pay_amt(),
            "payment_ratio": avg_pay_amt() / (F.abs(avg_bill_amt()) + F.lit(1.0)),
            "credit_util": utilization_ratio(),
        }
    )
