"""Column expressions over loan tables. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text to typed values: unreadable text becomes NULL instead of failing the job -------------


def number(column: str | Column, dtype: str = "double") -> Column:
    return as_column(column).try_cast(dtype)


def day(column: str | Column, pattern: str = "MM/dd/yyyy") -> Column:
    """Text to date. ``MM/dd`` insists on two digits; pass ``M/d/yyyy`` to accept both forms."""
    return F.try_to_date(as_column(column), pattern)


def instant(column: str | Column, pattern: str = "MM/dd/yyyy HH:mm:ss") -> Column:
    return F.try_to_timestamp(as_column(column), F.lit(pattern))


def cast_numbers(df: DataFrame, columns: Sequence[str], dtype: str = "double") -> DataFrame:
    """Cast the named columns that exist, in one projection; casting twice changes nothing."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: number(c, dtype) for c in present})


# --- calendar -----------------------------------------------------------------------------------


def quarter_label(date: str | Column) -> Column:
    """``2015Q2``; NULL for a NULL date."""
    date = as_column(date)
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


# --- predicates ---------------------------------------------------------------------------------


def between_half_open(column: str | Column, low: float, high: float) -> Column:
    column = as_column(column)
    return (column >= F.lit(low)) & (column < F.lit(high))


def missing(df: DataFrame, column: str) -> Column:
    """NULL, or NaN where the column can hold one."""
    test = F.col(column).isNull()
    if df.schema[column].dataType.typeName() in ("float", "double"):
        test = test | F.isnan(column)
    return test


def only_default(status: str | Column = V.STATUS) -> Column:
    return as_column(status) == F.lit(V.DEFAULT)


def troubled(status: str | Column = V.STATUS) -> Column:
    """The exploration set: grace period counts, charged off does not."""
    return as_column(status).isin(*V.TROUBLED)


def bad_label(status: str | Column = V.STATUS) -> Column:
    """The modelling label: charged off counts, grace period does not; NULL status is 0."""
    return F.when(as_column(status).isin(*V.LABELLED_BAD), 1).otherwise(0)


# --- binning and ordinal codes --------------------------------------------------------------------


def bin_label(
    column: str | Column, edges: Sequence[float], labels: Sequence[str], other: str
) -> Column:
    """Label of the half-open bin holding the value.

    Everything outside the bins takes ``other``: values past the last edge, values below the first
    edge, NULL and NaN alike.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    bins = list(zip(edges, edges[1:], labels))
    low, high, label = bins[0]
    first = F.when(between_half_open(column, low, high), F.lit(label))
    chain = reduce(
        lambda built, b: built.when(between_half_open(column, b[0], b[1]), F.lit(b[2])),
        bins[1:],
        first,
    )
    return chain.otherwise(F.lit(other))


def income_range(column: str | Column = "annual_inc") -> Column:
    return bin_label(column, V.INCOME_EDGES, V.INCOME_RANGES, V.INCOME_OTHER)


def rate_range(column: str | Column = "int_rate") -> Column:
    return bin_label(column, V.RATE_EDGES, V.RATE_RANGES, V.RATE_OTHER)


def ordinal(column: str | Column, codes: Mapping[str, int], default: int = 0) -> Column:
    """Look each text up in ``codes``; text that is not there, or NULL, takes ``default``."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_column(column)), F.lit(default))


def employment_years(column: str | Column = V.ORDINAL_CATEGORY) -> Column:
    return ordinal(column, V.EMP_LENGTH_YEARS)


# --- deterministic hashing ----------------------------------------------------------------------


def hash32(*parts: str | Column) -> Column:
    """First 32 bits of the md5 of the joined parts, as a long.

    It depends only on the row's own values, so a recomputed task, another partitioning or another
    SQL engine gives the same number.
    """
    joined = F.concat_ws("|", *[as_column(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")
