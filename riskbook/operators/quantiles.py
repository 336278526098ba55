"""Exact and approximate quantiles, five-number summaries and box statistics per group.

An exact quantile takes two narrow scans and almost no shuffle. The first counts values per slice of
the number line, combined inside the map tasks, and tells which slice holds each wanted rank. The
second keeps only the values in those slices, counts the equal ones and walks to the rank.

A slice is a fixed share of the value, so a column whose values crowd far from zero (epoch seconds) has few and
large ones. A wanted slice of more than ``ORDERED_ROWS`` values is cut again, evenly between its own smallest and
largest value, and again what holds the rank of it, until it is small or all its values are equal: four times at
most, as a slice spans 2**42 doubles and each cut divides it by ``SUB_SLICES``. So no task ever holds a group, and
none orders more than ``ORDERED_ROWS`` values or ``SUB_SLICES`` counts of a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.operators.lookup import attach, materialised

SLICES_PER_OCTAVE = 1024
SUB_SLICES = 4096
ORDERED_ROWS = 100_000
_LOWEST_EXPONENT = 1075  # log2 of the smallest positive double is above -1075

QUARTILES = (0.25, 0.5, 0.75)
FIVE = (0.0, 0.25, 0.5, 0.75, 1.0)
FIVE_NAMES = ("low", "q1", "median", "q3", "high")


def slice_of(value: Column, per_octave: int = SLICES_PER_OCTAVE) -> Column:
    """A long that never decreases as the value grows: a logarithmic slice of the number line.

    It needs no minimum or maximum, so it costs no pass over the data, and a few wild values
    cannot crowd all others into one slice.
    """
    height = F.floor((F.log2(F.abs(value)) + _LOWEST_EXPONENT) * per_octave)
    return F.when(value == 0, F.lit(0).cast("bigint")).otherwise(
        F.signum(value).cast("bigint") * height
    )


def measurements(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Keys and one measure named ``value``, without NULL and NaN. NULL keys are kept as a group."""
    return df.select(*keys, F.col(value).cast("double").alias("value")).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def _positions(total: Column, probabilities: Sequence[float], method: str) -> list[Column]:
    """Zero-based positions of the quantiles among ``total`` ordered values."""
    if method == "linear":
        return [F.lit(float(p)) * (total - 1) for p in probabilities]
    return [
        F.greatest(F.ceil(F.lit(float(p)) * total) - 1, F.lit(0)).cast("double")
        for p in probabilities
    ]


def _ranks(total: Column, probabilities: Sequence[float], method: str) -> list[Column]:
    """The two whole ranks around each position."""
    return [
        end(p).cast("bigint")
        for p in _positions(total, probabilities, method)
        for end in (F.floor, F.ceil)
    ]


def sub_slice(value: Column, lowest: Column, highest: Column) -> Column:
    """The number of an even cut between two different values; it never decreases as the value grows."""
    return F.least(
        F.floor((value - lowest) / (highest - lowest) * SUB_SLICES), F.lit(SUB_SLICES - 1).cast("bigint")
    )


def slice_counts(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number, smallest and largest of the values of each group in each slice; kept, as several steps read it."""
    value = F.col("value")
    counted = rows.groupBy(*keys, slice_of(value).alias("slice")).agg(
        F.count(F.lit(1)).alias("held"), F.min("value").alias("lowest"), F.max("value").alias("highest")
    )
    return materialised(counted, "slices")


def _holding(counted: DataFrame, within: Window, before: Column, ranks) -> DataFrame:
    """The counted parts that hold a wanted rank, with the number of values before each."""
    upto = F.sum("held").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counted.withColumn("before", before + upto - F.col("held"))
    return placed.where(
        F.exists(
            F.array(*ranks),
            lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("held")),
        )
    )


def _within(rows: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that lie in one of some parts of slices, with that part's columns."""
    found = attach(rows, parts, [*keys, "slice"], ("before", "total", "lowest", "highest"))
    return found.where(F.col("value").between(F.col("lowest"), F.col("highest")))


def _wanted_parts(
    cut: DataFrame, counts: DataFrame, keys: Sequence[str], probabilities: Sequence[float], method: str, most: int
) -> DataFrame:
    """Keys, slice, lowest, highest, held, before, total: the parts of slices that hold the wanted ranks, each of at most
    ``most`` values or of equal ones."""
    ranks = _ranks(F.col("total"), probabilities, method)
    columns = [*keys, "slice", "lowest", "highest", "held", "before", "total"]
    by_key = Window.partitionBy(*keys)
    summed = counts.withColumn("total", F.sum("held").over(by_key))
    parts = materialised(_holding(summed, by_key.orderBy("slice"), F.lit(0), ranks).select(*columns), "ranks")
    crowded = (F.col("held") > most) & (F.col("lowest") < F.col("highest"))
    while not parts.where(crowded).isEmpty():
        number = sub_slice(F.col("value"), F.col("lowest"), F.col("highest")).alias("number")
        inner = (
            _within(cut, parts.where(crowded), keys)
            .groupBy(*keys, "slice", F.col("lowest").alias("start"), F.col("before").alias("base"), "total", number)
            .agg(F.count(F.lit(1)).alias("held"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
        )
        by_part = Window.partitionBy(*keys, "slice", "start").orderBy("number")
        finer = _holding(inner, by_part, F.col("base"), ranks).select(*columns)
        parts = materialised(parts.where(~crowded).unionByName(finer), "ranks")
    return parts


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float] = QUARTILES,
    names: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    method: str = "linear",
    accuracy: int = 10_000,
    counts: DataFrame | None = None,
    most: int = ORDERED_ROWS,
) -> DataFrame:
    """Quantiles of one column per group, with the group's count ``n``.

    ``linear`` interpolates between neighbours, ``lower`` returns an observed value; both are exact.
    ``approx`` is Spark's mergeable sketch: one pass and bounded memory, with a rank error of at
    most 1/accuracy of the group. ``counts`` takes the column's :func:`slice_counts` where they are there already;
    ``most`` is the number of values of a slice that a task may order.
    """
    keys = list(keys)
    names = list(names or [f"q{round(100 * p)}" for p in probabilities])
    rows = measurements(df, value, keys)
    if method == "approx":
        sketch = F.percentile_approx("value", [float(p) for p in probabilities], accuracy)
        found = rows.groupBy(*keys).agg(F.count("value").alias("n"), sketch.alias("found"))
        picks = [F.col("found")[i].alias(name) for i, name in enumerate(names)]
        return found.select(*keys, "n", *picks)
    if method not in ("linear", "lower"):
        raise ValueError("method is 'linear', 'lower' or 'approx'")

    if counts is None:
        counts = slice_counts(rows, keys)
    cut = rows.withColumn("slice", slice_of(F.col("value")))
    parts = _wanted_parts(cut, counts, keys, probabilities, method, most)
    place = [*keys, "slice", "lowest", "before", "total"]
    equal = F.col("lowest") == F.col("highest")
    tied = (
        _within(cut, parts.where(~equal), keys)
        .groupBy(*place, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .unionByName(parts.where(equal).select(*place, F.col("lowest").alias("value"), F.col("held").alias("n")))
    )
    climb = (
        Window.partitionBy(*keys, "slice", "lowest")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = tied.withColumn("end", F.col("before") + F.sum("n").over(climb))

    picks = []
    for i, rank in enumerate(_ranks(F.col("total"), probabilities, method)):
        here = (rank < F.col("end")) & (rank >= F.col("end") - F.col("n"))
        picks.append(F.max(F.when(here, F.col("value"))).alias(f"at{i}"))
    size = F.coalesce(F.max("total"), F.lit(0)).alias("n")
    picked = placed.groupBy(*keys).agg(size, *picks)
    results = []
    for i, position in enumerate(_positions(F.col("n"), probabilities, method)):
        low, high = F.col(f"at{2 * i}"), F.col(f"at{2 * i + 1}")
        results.append((low + (high - low) * (position - F.floor(position))).alias(names[i]))
    return picked.select(*keys, "n", *results)


def median(
    df: DataFrame, value: str, keys: Sequence[str] = (), method: str = "lower", **options
) -> DataFrame:
    return quantiles(df, value, (0.5,), (f"median_{value}",), keys, method, **options).drop("n")


def five_numbers(
    df: DataFrame, value: str, keys: Sequence[str] = (), method: str = "linear", **options
) -> DataFrame:
    """n, min, lower quartile, median, upper quartile and max per group."""
    return quantiles(df, value, FIVE, FIVE_NAMES, keys, method, **options)


def box_stats(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    method: str = "linear",
    reach: float = 1.5,
    most: int = ORDERED_ROWS,
) -> DataFrame:
    """Five numbers, plus whiskers and the outlier count, per group.

    Whiskers are the smallest and largest values within ``reach`` interquartile ranges of the
    quartiles. The counts per slice that led to the quartiles answer for every slice that lies on one side of the
    fences; values are only read again from the slices that a fence cuts, two a group at most.
    """
    keys = list(keys)
    rows = measurements(df, value, keys)
    counts = slice_counts(rows, keys)
    spread = F.col("q3") - F.col("q1")
    numbers = materialised(
        five_numbers(df, value, keys, method, counts=counts, most=most)
        .withColumn("floor", F.col("q1") - reach * spread)
        .withColumn("ceiling", F.col("q3") + reach * spread)
        .withColumn("everyone", F.lit(1)),
        "fences",
    )
    shown = ("n", *FIVE_NAMES)
    fences = (*shown, "floor", "ceiling")
    placed = attach(counts.withColumn("everyone", F.lit(1)), numbers, keys or ["everyone"], fences)
    inside = (F.col("lowest") >= F.col("floor")) & (F.col("highest") <= F.col("ceiling"))
    outside = (F.col("highest") < F.col("floor")) | (F.col("lowest") > F.col("ceiling"))
    plain = placed.where(inside | outside).select(
        *keys, *shown,
        F.when(inside, F.col("lowest")).alias("low_end"),
        F.when(inside, F.col("highest")).alias("high_end"),
        F.when(inside, 0).otherwise(F.col("held")).alias("beyond"),
    )
    cut = rows.withColumn("slice", slice_of(F.col("value")))
    near = attach(cut, placed.where(~(inside | outside)), [*keys, "slice"], fences)
    kept = F.col("value").between(F.col("floor"), F.col("ceiling"))
    mixed = near.select(
        *keys, *shown,
        F.when(kept, F.col("value")).alias("low_end"),
        F.when(kept, F.col("value")).alias("high_end"),
        F.when(kept, 0).otherwise(1).cast("bigint").alias("beyond"),
    )
    return plain.unionByName(mixed).groupBy(*keys, *shown).agg(
        F.min("low_end").alias("whisker_low"),
        F.max("high_end").alias("whisker_high"),
        F.sum("beyond").alias("outliers"),
    )
