"""Confidence intervals of a mean or a sum per group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions.expressions import hash32
from riskbook.operators.aggregates import money_mean

Z95 = 1.96


def normal_interval(
    df: DataFrame, keys: Sequence[str], value: str, statistic: str = "mean", scale: int | None = 2
) -> DataFrame:
    """Closed-form 95% interval: one pass, nothing resampled."""
    mean = money_mean(value, scale)
    half = Z95 * F.stddev_samp(value) / F.sqrt(F.count(value).cast("double"))
    factor = F.count(value) if statistic == "sum" else F.lit(1)
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"),
        (mean * factor).alias("estimate"),
        ((mean - half) * factor).alias("low"),
        ((mean + half) * factor).alias("high"),
    )


def poisson_weight(uniform: Column) -> Column:
    """Poisson(1) draw from a uniform number in [0, 1): how many steps of its CDF lie at or below."""
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append((uniform >= total).cast("int"))
    return sum(steps[1:], steps[0])


def bootstrap_interval(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    identity: Sequence[str],
    statistic: str = "mean",
    replicates: int = 200,
    buckets: int = 256,
    level: float = 0.95,
    seed: int = 1395,
    scale: int | None = 2,
) -> DataFrame:
    """Poisson bootstrap interval over hashed buckets of rows.

    Every row falls into one of ``buckets`` by the hash of its ``identity``; a group then is that
    many (count, sum) pairs, made in one pass. Replicates reweight buckets, so their cost is
    groups x buckets x replicates and does not grow with the rows, and a group holding a third of
    the table is spread over its buckets. ``buckets`` only sets how well the width is known, to about
    1 / sqrt(2 x buckets). A resample has as many rows as the group, so the sum is the group's
    number of rows times the resampled mean. Weights come from hashes and, with a ``scale``, sums are
    exact decimals: a rerun gives the same interval.
    """
    keys = list(keys)
    bucket = F.pmod(hash32(*identity, F.lit(seed)), F.lit(buckets))
    addend = F.col(value) if scale is None else F.col(value).cast(f"decimal(18,{scale})")
    pairs = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, bucket.alias("bucket"))
        .agg(F.count(value).alias("n"), F.sum(addend).alias("s"))
    )
    uniform = hash32(*keys, "bucket", "replicate", F.lit(seed)) / F.lit(2.0**32)
    draws = pairs.withColumn(
        "replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))
    ).withColumn("weight", poisson_weight(uniform))
    total = F.sum(F.col("weight") * F.col("s")).cast("double")
    mean = F.try_divide(total, F.sum(F.col("weight") * F.col("n")))
    estimate = mean * F.sum("n") if statistic == "sum" else mean
    tails = F.percentile(
        "estimate", F.array(F.lit((1 - level) / 2), F.lit((1 + level) / 2))
    )
    return (
        draws.groupBy(*keys, "replicate")
        .agg(estimate.alias("estimate"))
        .groupBy(*keys)
        .agg(F.count("estimate").alias("replicates"), tails.alias("tails"))
        .select(*keys, "replicates", F.col("tails")[0].alias("low"), F.col("tails")[1].alias("high"))
    )
