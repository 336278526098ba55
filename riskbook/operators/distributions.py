"""Histograms, kernel densities and gamma fits: the numbers behind distribution charts.

Rows are reduced to a bounded number of bins per group in one pass; everything after that works on
the bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.operators.lookup import attach, materialised
from riskbook.operators.quantiles import measurements, quantiles

MOST_BINS = 50
_REACH = 6  # bandwidths beyond which a kernel counts for nothing


def freedman_diaconis(
    n: Column, q1: Column, q3: Column, low: Column, high: Column, most: int = MOST_BINS
) -> Column:
    """Bin count from the interquartile range; root-n bins where that range is zero.

    At most ``most`` bins, since a chart can show no more; a table of counts may ask for any number.
    """
    width = 2 * (q3 - q1) * F.pow(n.cast("double"), F.lit(-1.0 / 3.0))
    bins = F.when(width > 0, F.ceil((high - low) / width)).otherwise(
        F.floor(F.sqrt(n.cast("double")))
    )
    return F.greatest(F.least(bins, F.lit(most).cast("bigint")), F.lit(1).cast("bigint"))


def histogram(
    df: DataFrame, value: str, bins: int | None = None, most_bins: int = MOST_BINS
) -> DataFrame:
    """Bins of equal width over the range of one column: edges, count and density, empty bins too.

    The range and the bin count reach the rows as a scalar subquery, so the rows are read, binned
    and counted with no join.
    """
    rows = measurements(df, value)
    if bins is None:
        range_of = quantiles(
            df, value, (0.0, 0.25, 0.75, 1.0), ("low", "q1", "q3", "high")
        ).withColumn(
            "bins",
            freedman_diaconis(*[F.col(c) for c in ("n", "q1", "q3", "low", "high")], most=most_bins),
        )
    else:
        range_of = rows.agg(
            F.count("value").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.lit(bins).cast("bigint").alias("bins"),
        )
    flat = F.col("high") == F.col("low")
    low = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))
    shape = materialised(  # a single row, or none for a table without values
        range_of.where(F.col("n") > 0).select(
            F.struct(
                "n", "bins", low.alias("low"), ((high - low) / F.col("bins")).alias("width")
            ).alias("shape")
        )
    )
    at = F.least(
        F.floor((F.col("value") - F.col("shape.low")) / F.col("shape.width")),
        F.col("shape.bins") - 1,
    )
    counted = (
        rows.withColumn("shape", shape.scalar())
        .select(at.alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    axis = shape.select("shape", F.explode(F.sequence(F.lit(0), F.col("shape.bins") - 1)).alias("bin"))
    count = F.coalesce(F.col("count"), F.lit(0))
    return axis.join(counted, "bin", "left").select(
        "bin",
        (F.col("shape.low") + F.col("bin") * F.col("shape.width")).alias("low"),
        (F.col("shape.low") + (F.col("bin") + 1) * F.col("shape.width")).alias("high"),
        count.alias("count"),
        (count / (F.col("shape.n") * F.col("shape.width"))).alias("density"),
    )


def kernel_density(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    points: int = 64,
    bins_per_bandwidth: int = 8,
    cut: float = 2.0,
) -> DataFrame:
    """Gaussian kernel density per group on an even grid.

    Bandwidth is Scott's rule on the group's own spread; the grid runs ``cut`` bandwidths past the
    group's smallest and largest value. One pass takes count, variance and range of each group, a
    second one counts rows in bins of a fixed share of that group's bandwidth. Only filled bins
    exist, so a far outlier costs one bin, and a bin reaches only the grid points within six
    bandwidths. A bin stands at the mean of its values, so the error is of second order in a
    share of the bandwidth, whatever the number of rows or the range. Groups with no spread have no density.
    """
    keys = list(keys)
    rows = measurements(df, value, keys)
    n = F.count("value")
    shape = (
        rows.groupBy(*keys)
        .agg(
            n.alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            (F.sqrt(F.var_samp("value")) * F.pow(n.cast("double"), F.lit(-0.2))).alias("h"),
        )
        .where(F.col("h") > 0)
    )
    columns = ("n", "low", "high", "h")
    if keys:
        shaped = attach(rows, shape, keys, columns)
    else:
        one = shape.select(F.struct(*columns).alias("shape")).scalar()
        shaped = rows.withColumn("shape", one).select("value", "shape.*")
    width = F.col("h") / bins_per_bandwidth
    held = (
        shaped.where(F.col("h") > 0)
        .groupBy(*keys, *columns, F.floor((F.col("value") - F.col("low")) / width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("held"), F.avg(F.col("value") - F.col("low")).alias("middle"))
    )
    start = -cut * F.col("h")
    step = (F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (points - 1)
    middle = F.col("middle")
    first = F.greatest(F.ceil((middle - _REACH * F.col("h") - start) / step), F.lit(0))
    last = F.least(F.floor((middle + _REACH * F.col("h") - start) / step), F.lit(points - 1))
    z = (start + F.col("point") * step - middle) / F.col("h")
    kernel = F.col("held") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))
    dense = (
        held.where(first <= last)
        .withColumn("point", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
        .groupBy(*keys, "point")
        .agg(F.sum(kernel).alias("density"))
    )
    grid = shape.select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
        (F.col("low") + start + F.col("point") * step).alias("x"),
    )
    tests = [grid[k].eqNullSafe(dense[k]) for k in keys]
    matched = reduce(lambda a, b: a & b, tests, grid["point"] == dense["point"])
    return grid.join(dense, matched, "left").select(
        *[grid[k] for k in keys],
        grid["point"],
        "x",
        F.coalesce("density", F.lit(0.0)).alias("density"),
    )


# --- gamma fit ----------------------------------------------------------------------------------

_SHIFT = 6  # the asymptotic series below are accurate to ~1e-10 from here on
_NEWTON_STEPS = 12


def _digamma(x: Column) -> Column:
    y = x + _SHIFT
    series = F.log(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6)
    return series - sum((1 / (x + k) for k in range(_SHIFT)), F.lit(0.0))


def _trigamma(x: Column) -> Column:
    y = x + _SHIFT
    series = 1 / y + 1 / (2 * y**2) + 1 / (6 * y**3) - 1 / (30 * y**5) + 1 / (42 * y**7)
    return series + sum((1 / (x + k) ** 2 for k in range(_SHIFT)), F.lit(0.0))


def _log_gamma(x: Column) -> Column:
    y = x + _SHIFT
    series = (
        (y - 0.5) * F.log(y)
        - y
        + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * y)
        - 1 / (360 * y**3)
        + 1 / (1260 * y**5)
    )
    return series - sum((F.log(x + k) for k in range(_SHIFT)), F.lit(0.0))


def gamma_sums(
    df: DataFrame, value: str, keys: Sequence[str] = (), location: float = 0.0
) -> DataFrame:
    """Count, sum and sum of logs of the values above ``location``, all that the fit needs, and the count of the
    others, ``below``, which no gamma distribution with this location can give."""
    above = F.col("value") > location
    x = F.when(above, F.col("value") - location)
    return (
        measurements(df, value, keys)
        .groupBy(*keys)
        .agg(
            F.count(x).alias("n"),
            F.sum(x).alias("sum_x"),
            F.sum(F.log(x)).alias("sum_log_x"),
            F.count_if(~above).alias("below"),
        )
    )


def _shape_and_scale(sums: DataFrame) -> DataFrame:
    """Maximum-likelihood shape, scale and log-likelihood from n, sum_x and sum_log_x; NULL for equal values."""
    gap = F.log(F.col("sum_x") / F.col("n")) - F.col("sum_log_x") / F.col("n")
    start = (3 - F.col("s") + F.sqrt((F.col("s") - 3) ** 2 + 24 * F.col("s"))) / (12 * F.col("s"))

    def newton(shape: Column, _step: Column) -> Column:
        error = F.log(shape) - _digamma(shape) - F.col("s")
        return shape - error / (1 / shape - _trigamma(shape))

    steps = F.sequence(F.lit(1), F.lit(_NEWTON_STEPS))
    likelihood = (
        (F.col("shape") - 1) * F.col("sum_log_x")
        - F.col("sum_x") / F.col("scale")
        - F.col("n") * (F.col("shape") * F.log("scale") + _log_gamma(F.col("shape")))
    )
    return (
        sums.withColumn("s", F.when(gap > 1e-12, gap))
        .withColumn("shape", F.aggregate(steps, start, newton))
        .withColumn("scale", F.col("sum_x") / F.col("n") / F.col("shape"))
        .withColumn("log_likelihood", likelihood)
    )


def gamma_fit(
    df: DataFrame, value: str, keys: Sequence[str] = (), location: float = 0.0
) -> DataFrame:
    """Maximum-likelihood gamma shape and scale per group, with the log-likelihood.

    One pass over the rows; Newton's method then runs on three sums per group as a fold over the
    step numbers. The location is given; :func:`gamma_fit_location` fits it as well. Values at or below it are
    counted as ``below``. Constant groups have no fit (NULL).
    """
    fitted = _shape_and_scale(gamma_sums(df, value, keys, location))
    return fitted.select(*keys, "n", "shape", "scale", "log_likelihood", "below")


# Candidates for the location lie below the smallest value, by these shares of the range: quarter octaves.
LOCATION_GAPS = tuple(2.0 ** (k / 4) for k in range(-40, 9))
LOCATION_BINS = 4096
_FINER = 8


def _location_profile(bins: DataFrame, keys: Sequence[str], gaps: Column) -> DataFrame:
    """The fit at each candidate location, a gap below the group's smallest value, from its bins."""
    groups = [*keys, "low", "high", "gap"]
    x = F.col("middle") + F.col("gap") * (F.col("high") - F.col("low"))
    sums = (
        bins.withColumn("gap", F.explode(gaps))
        .groupBy(*groups)
        .agg(
            F.sum("held").alias("n"),
            F.sum(F.col("held") * x).alias("sum_x"),
            F.sum(F.col("held") * F.log(x)).alias("sum_log_x"),
        )
    )
    return _shape_and_scale(sums).withColumn(
        "location", F.col("low") - F.col("gap") * (F.col("high") - F.col("low"))
    )


def _best_gap(profile: DataFrame, keys: Sequence[str]) -> DataFrame:
    ranked = F.struct((-F.col("log_likelihood")).alias("least"), "gap", "location", "n", "shape", "scale")
    fitting = profile.where(F.col("log_likelihood").isNotNull())
    return fitting.groupBy(*keys).agg(F.min(ranked).alias("best"))


def gamma_fit_location(
    df: DataFrame, value: str, keys: Sequence[str] = (), refine: bool = True
) -> DataFrame:
    """Maximum-likelihood gamma location, shape and scale per group, with the log-likelihood.

    Two passes over the rows: count and range of each group, then counts in ``LOCATION_BINS`` even bins that each stand
    at the mean of their values, so values that repeat are exact. On these bins the likelihood is taken along
    the location, at ``LOCATION_GAPS`` of the range below the smallest value, and with ``refine`` again on a finer
    grid around the best. The smallest gap keeps clear of the value itself, where the likelihood of shapes
    below 1 has no bound. No row lies below such a location. Constant groups have no fit and no row.
    """
    keys = list(keys)
    rows = measurements(df, value, keys).withColumn("everyone", F.lit(1))
    by = keys or ["everyone"]
    ends = materialised(
        rows.groupBy(*by)
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .where(F.col("low") < F.col("high")),
        "ends",
    )
    ranged = attach(rows, ends, by, ("low", "high"))
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    bins = materialised(
        ranged.groupBy(*by, "low", "high", F.floor(share * LOCATION_BINS).alias("bin")).agg(
            F.count(F.lit(1)).alias("held"), F.avg(F.col("value") - F.col("low")).alias("middle")
        ),
        "bins",
    )
    found = _best_gap(_location_profile(bins, by, F.array(*[F.lit(g) for g in LOCATION_GAPS])), by)
    if refine:
        near = F.array(*[F.col("best.gap") * 2.0 ** (k / (4 * _FINER)) for k in range(-_FINER + 1, _FINER)])
        chosen = materialised(found.select(*by, near.alias("gaps")), "gaps")
        finer = attach(bins, chosen, by, ("gaps",))
        found = _best_gap(_location_profile(finer, by, F.col("gaps")), by)
    return found.select(
        *keys, "best.n", "best.location", "best.shape", "best.scale", (-F.col("best.least")).alias("log_likelihood")
    )
