"""The exploratory analysis of a loan table: derived columns, then one function per report.

Every report takes the table that ``prepare`` returns and gives a small table of results. Nothing is
collected.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import (
    day,
    income_range,
    number,
    only_default,
    quarter_label,
    rate_range,
    troubled,
)
from riskbook.operators.aggregates import (
    count_per,
    in_fixed_order,
    max_per,
    mean_per,
    min_per,
    money_sum,
    sum_per,
)
from riskbook.operators.distributions import gamma_fit, histogram, kernel_density
from riskbook.operators.quantiles import box_stats, median
from riskbook.sources.tables import register_view

MEASURES = ("loan_amnt", "int_rate", "annual_inc", "total_acc")


def prepare(df: DataFrame, date_pattern: str = "MM/dd/yyyy", dtype: str = "double") -> DataFrame:
    """Add the analysis columns: numeric measures, issue date and quarter, income and rate ranges."""
    typed = df.withColumns({c: number(c, dtype) for c in MEASURES if c in df.columns})
    is_text = df.schema["issue_d"].dataType.typeName() == "string"
    date = day("issue_d", date_pattern) if is_text else F.col("issue_d").cast("date")
    return typed.withColumns(
        {
            "issue_d_dateType": date,
            "issue_year": quarter_label(date),
            "annual_inc_range": income_range("annual_inc"),
            "int_rate_range": rate_range("int_rate"),
        }
    )


# --- over time ------------------------------------------------------------------------------------


def loans_per_quarter(df: DataFrame) -> DataFrame:
    return count_per(df, "issue_year")


def amount_per_issue_date(df: DataFrame) -> DataFrame:
    return sum_per(df, "issue_d_dateType", "loan_amnt")


def median_per_quarter(df: DataFrame, value: str, method: str = "approx") -> DataFrame:
    return median(df, value, ["issue_year"], method).orderBy("issue_year")


def median_per_quarter_sql(df: DataFrame, value: str, accuracy: int = 10_000) -> DataFrame:
    """The same report as SQL text over a registered view."""
    register_view(df, "loans_view")
    return df.sparkSession.sql(
        f"""
        SELECT issue_year, percentile_approx({value}, 0.5, {accuracy}) AS median_{value}
        FROM loans_view
        GROUP BY issue_year
        ORDER BY issue_year
        """
    )


# --- by status ------------------------------------------------------------------------------------


def status_counts(df: DataFrame) -> DataFrame:
    return count_per(df, V.STATUS, largest_first=True)


def defaults_by_verification(df: DataFrame) -> DataFrame:
    return count_per(df, "verification_status", where=only_default())


def amount_per_status(df: DataFrame) -> DataFrame:
    return sum_per(df, V.STATUS, "loan_amnt")


def accounts_by_status(df: DataFrame, method: str = "linear") -> DataFrame:
    return box_stats(df, "total_acc", [V.STATUS], method)


def amount_density_by_status(df: DataFrame, **options) -> DataFrame:
    return kernel_density(df, "loan_amnt", [V.STATUS], **options)


# --- by state -------------------------------------------------------------------------------------


def amount_per_state(df: DataFrame) -> DataFrame:
    return df.groupBy("addr_state").agg(money_sum("loan_amnt").alias("sum_loan_amnt"))


def median_rate_per_state(df: DataFrame, method: str = "approx") -> DataFrame:
    return median(df, "int_rate", ["addr_state"], method)


def max_rate_per_state(df: DataFrame) -> DataFrame:
    return max_per(df, "addr_state", "int_rate")


def min_rate_per_state(df: DataFrame) -> DataFrame:
    return min_per(df, "addr_state", "int_rate")


# --- by grade, income, employment and purpose ---------------------------------------------------


def box_by_sub_grade(df: DataFrame, value: str, method: str = "linear") -> DataFrame:
    return box_stats(df, value, ["sub_grade", "grade"], method)


def income_by_status(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("annual_inc_range", V.STATUS)
        .agg(F.count(F.lit(1)).alias("n"), money_sum("loan_amnt").alias("sum_loan_amnt"))
        .orderBy("annual_inc_range", V.STATUS)
    )


def rate_by_employment(df: DataFrame, method: str = "linear") -> DataFrame:
    return in_fixed_order(
        box_stats(df, "int_rate", [V.ORDINAL_CATEGORY], method),
        V.ORDINAL_CATEGORY,
        V.EMP_LENGTH_ORDER,
        ["n", "outliers"],
    )


def amount_density_by_employment(df: DataFrame, **options) -> DataFrame:
    return kernel_density(df, "loan_amnt", [V.ORDINAL_CATEGORY, "term"], **options)


def purpose_counts(df: DataFrame) -> DataFrame:
    return count_per(df, "purpose")


def density_by_purpose(df: DataFrame, value: str, **options) -> DataFrame:
    return kernel_density(df, value, ["purpose", "term"], **options)


# --- defaulted loans -------------------------------------------------------------------------------


def troubled_loans(df: DataFrame) -> DataFrame:
    return df.where(troubled()).select(
        "annual_inc_range", "loan_amnt", "emp_length", "int_rate", "sub_grade", "int_rate_range"
    )


def mean_amount_of_troubled(df: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    return in_fixed_order(mean_per(troubled_loans(df), key, "loan_amnt"), key, order, ["n"])


def box_of_troubled_by_employment(df: DataFrame, value: str, method: str = "linear") -> DataFrame:
    return in_fixed_order(
        box_stats(troubled_loans(df), value, [V.ORDINAL_CATEGORY], method),
        V.ORDINAL_CATEGORY,
        V.EMP_LENGTH_ORDER,
        ["n", "outliers"],
    )


# --- the whole analysis ---------------------------------------------------------------------------


def reports(
    df: DataFrame, method: str = "linear", trend: str = "approx"
) -> dict[str, Callable[[], DataFrame]]:
    """Every exploration report over a prepared table, by name, as a function that builds it.

    Some reports measure a summary before they are planned, so nothing runs for those not asked for.
    ``method`` and ``trend`` choose exact or sketched quantiles for the boxes and the medians.
    """
    found = {
        "loans_per_quarter": partial(loans_per_quarter, df),
        "amount_per_issue_date": partial(amount_per_issue_date, df),
        "status_counts": partial(status_counts, df),
        "defaults_by_verification": partial(defaults_by_verification, df),
        "amount_per_status": partial(amount_per_status, df),
        "accounts_by_status": partial(accounts_by_status, df, method),
        "amount_density_by_status": partial(amount_density_by_status, df),
        "amount_per_state": partial(amount_per_state, df),
        "median_rate_per_state": partial(median_rate_per_state, df, trend),
        "max_rate_per_state": partial(max_rate_per_state, df),
        "min_rate_per_state": partial(min_rate_per_state, df),
        "income_by_status": partial(income_by_status, df),
        "rate_by_employment": partial(rate_by_employment, df, method),
        "amount_density_by_employment": partial(amount_density_by_employment, df),
        "purpose_counts": partial(purpose_counts, df),
        "mean_troubled_by_income": partial(mean_amount_of_troubled, df, "annual_inc_range", V.INCOME_ORDER),
        "mean_troubled_by_sub_grade": partial(mean_amount_of_troubled, df, "sub_grade", V.SUB_GRADE_ORDER),
        "mean_troubled_by_rate": partial(mean_amount_of_troubled, df, "int_rate_range", V.RATE_ORDER),
    }
    for value in ("loan_amnt", "int_rate"):
        found |= {
            f"histogram_{value}": partial(histogram, df, value),
            f"density_{value}": partial(kernel_density, df, value),
            f"gamma_{value}": partial(gamma_fit, df, value),
            f"box_{value}": partial(box_stats, df, value, (), method),
            f"median_{value}_per_quarter": partial(median_per_quarter, df, value, trend),
            f"box_{value}_by_sub_grade": partial(box_by_sub_grade, df, value, method),
            f"density_{value}_by_purpose": partial(density_by_purpose, df, value),
            f"box_{value}_of_troubled": partial(box_of_troubled_by_employment, df, value, method),
        }
    return found

