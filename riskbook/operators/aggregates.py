"""Counts, sums and extremes per key.

All of these combine inside each map task before the shuffle, so a key that holds a third of the
table sends one partial row per task like any other key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.expressions import as_column, number


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def money_sum(value: str | Column, scale: int | None = 2) -> Column:
    """Sum returned as a double.

    With a ``scale`` the addends are exact decimals, so neither the order of the rows nor a retried
    task can change the last digits. ``scale=None`` adds doubles, for data with no fixed scale.
    """
    value = as_column(value)
    if scale is None:
        return F.sum(value)
    return F.sum(value.cast(f"decimal(18,{scale})")).cast("double")


def money_mean(value: str | Column, scale: int | None = 2) -> Column:
    return F.try_divide(money_sum(value, scale), F.count(as_column(value)))


def count_per(
    df: DataFrame,
    keys: str | Sequence[str],
    where: str | Column | None = None,
    largest_first: bool = False,
    name: str = "n",
) -> DataFrame:
    """Rows per key, grouped first and ordered after. Ties in the count are ordered by key."""
    keys = _keys(keys)
    if where is not None:
        df = df.where(where)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    order = [F.desc(name), *keys] if largest_first else keys
    return counted.orderBy(*order)


def sum_per(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    scale: int | None = 2,
    name: str | None = None,
) -> DataFrame:
    keys = _keys(keys)
    total = money_sum(value, scale).alias(name or f"sum_{value}")
    return df.groupBy(*keys).agg(total).orderBy(*keys)


def mean_per(
    df: DataFrame,
    keys: str | Sequence[str],
    value: str,
    where: str | Column | None = None,
    scale: int | None = 2,
) -> DataFrame:
    keys = _keys(keys)
    if where is not None:
        df = df.where(where)
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), money_mean(value, scale).alias(f"mean_{value}")
    )


def max_per(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(F.max(value).alias(f"max_{value}"))


def min_per(df: DataFrame, keys: str | Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*_keys(keys)).agg(F.min(value).alias(f"min_{value}"))


def tally(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Row count and the count of rows meeting each condition, all in one pass."""
    counts = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def mean_of_text(df: DataFrame, column: str, scale: int | None = None) -> DataFrame:
    """Mean of a column still held as text; unreadable values are left out."""
    return df.agg(money_mean(number(column), scale).alias(f"mean_{column}"))


def describe_text(df: DataFrame, column: str) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency.

    Equal frequencies resolve to the smallest value. The per-value counts are reduced pairwise, so
    no task sees the whole list of values.
    """
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    leader = F.min(F.struct((-F.col("n")).alias("rank"), F.col(column).alias("value")))
    return per_value.agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), leader.alias("leader")
    ).select(
        F.coalesce("count", F.lit(0)).alias("count"),
        "unique",
        F.col("leader.value").alias("top"),
        (-F.col("leader.rank")).alias("freq"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def in_fixed_order(
    summary: DataFrame,
    key: str,
    order: Sequence[str],
    zeros: Sequence[str] = (),
    outside: bool = False,
) -> DataFrame:
    """Put a per-key summary into a fixed category order and show the empty categories too.

    Values outside the order are left out, as a chart with a fixed axis leaves them out; with ``outside`` they follow
    behind it, NULL last, all with the rank after the last. Columns in
    ``zeros`` show 0 for an empty category, the others NULL.
    """
    values = F.array(*[F.lit(v) for v in order])
    axis = summary.sparkSession.range(1).select(F.posexplode(values).alias("rank", key))
    rest = [c for c in summary.columns if c != key]
    shown = axis.join(summary, key, "left").select("rank", key, *rest)
    if zeros:
        shown = shown.fillna(0, subset=list(zeros))
    if outside:
        strange = ~F.coalesce(F.col(key).isin(list(order)), F.lit(False))
        behind = summary.where(strange).select(F.lit(len(order)).alias("rank"), key, *rest)
        return shown.unionByName(behind).orderBy("rank", F.asc_nulls_last(key))
    return shown.orderBy("rank")


def category_codes(df: DataFrame, column: str, order: Sequence[str]) -> Column:
    """Code of a value within a fixed order; -1 when it is not there or NULL."""
    values = F.array(*[F.lit(v) for v in order])
    return F.coalesce(F.array_position(values, F.col(column)) - 1, F.lit(-1)).cast("int")
