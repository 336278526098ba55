"""Missing-value profiles, fills and drops."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import bad_label, cast_numbers, day, missing, number
from riskbook.operators.lookup import materialised


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, missing values and missing share of every column.

    One aggregate over all columns, then one row turned into one row per column: a single scan
    however wide the table is.
    """
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.struct(*[F.count_if(missing(df, c)).alias(f"c{i}") for i, c in enumerate(columns)]).alias(
            "nulls"
        ),
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"nulls.c{i}").alias("nulls"))
            for i, c in enumerate(columns)
        ]
    )
    return counted.select("rows", F.inline(entries)).select(
        "column",
        "rows",
        "nulls",
        F.try_divide(F.col("nulls").cast("double"), F.col("rows")).alias("null_ratio"),
    )


def over_threshold(profile: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Columns missing in strictly more than ``threshold`` of the rows; exactly half stays."""
    return profile.where(F.col("nulls") > F.col("rows") * F.lit(threshold))


def mostly_missing(df: DataFrame, threshold: float = 0.5) -> list[str]:
    """Names of those columns. At most one short row per column reaches the driver."""
    return [r["column"] for r in over_threshold(null_profile(df), threshold).collect()]


def drop_missing(
    df: DataFrame, threshold: float = 0.5, columns: Sequence[str] | None = None
) -> DataFrame:
    """Drop a fixed list of columns, or measure which ones to drop when none is given."""
    return df.drop(*(mostly_missing(df, threshold) if columns is None else columns))


def fill_where(df: DataFrame, columns: Sequence[str], value: object, condition: Column) -> DataFrame:
    """Fill missing values with a constant, only in rows that meet ``condition``."""
    return df.withColumns(
        {
            c: F.when(F.col(c).isNull() & condition, F.lit(value)).otherwise(F.col(c))
            for c in columns
        }
    )


def fill_settled_balances(
    df: DataFrame, columns: Sequence[str] = ("tot_cur_bal", "tot_coll_amt")
) -> DataFrame:
    """A finished loan with no recorded balance has a balance of zero."""
    typed = df.withColumns({c: number(c) for c in columns})
    return fill_where(typed, columns, 0.0, F.col(V.STATUS).isin(*V.SETTLED))


def fill_mean(
    df: DataFrame, column: str = "total_rev_hi_lim", truncate: bool = True, scale: int | None = None
) -> DataFrame:
    """Fill missing values of one column with its mean, cut to whole units by default.

    The mean is a scalar subquery: one extra scan of one column and no job at build time. With
    ``scale`` the sum is taken in exact decimals, so the mean cannot vary between runs.
    """
    value = number(column)
    total = F.sum(value.cast(f"decimal(18,{scale})")).cast("double") if scale else F.sum(value)
    mean = F.try_divide(total, F.count(value))
    if truncate:
        mean = mean.cast("bigint").cast("double")
    fill = df.agg(mean.alias("mean")).scalar()
    return df.withColumn(column, F.coalesce(value, fill))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL, or NaN in a numeric column."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def impute(df: DataFrame, columns: Sequence[str], strategy: str = "mean", suffix: str = "_imputed"):
    """Mean, median or mode imputation with the library's own estimator."""
    outputs = [f"{c}{suffix}" for c in columns]
    imputer = Imputer(inputCols=list(columns), outputCols=outputs, strategy=strategy)
    return imputer.fit(df).transform(df)


def pair_statistics(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Sample covariance and correlation of each pair of columns, all in one pass."""
    measures = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("left"),
                    F.lit(b).alias("right"),
                    F.covar_samp(a, b).alias("covariance"),
                    F.corr(a, b).alias("correlation"),
                )
                for a, b in pairs
            ]
        ).alias("measures")
    )
    return measures.select(F.inline("measures"))


def frequent_items(df: DataFrame, columns: Sequence[str], support: float = 0.01) -> DataFrame:
    """The values that more than ``support`` of all rows hold, with their counts: column, value (as text), n, share.

    The library's counters, at most 1/support for each column and merged from task to task, name a superset of those
    values in one pass; a second pass counts these few exactly, and what does not reach the support goes. So the result
    is exact, and nothing grows with the number of distinct values. NULL is a value like any other.
    """
    columns = list(columns)
    names = [f"c{i}" for i in range(len(columns))]
    texts = df.select(*[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)])
    # The library's counters take no NULL; a mark in front tells it from all texts.
    marked = texts.select(*[F.coalesce(F.concat(F.lit("="), F.col(n)), F.lit("-")).alias(n) for n in names])
    candidates = marked.stat.freqItems(names, support)
    listed = F.array(
        *[F.struct(F.lit(i).alias("at"), F.col(f"{n}_freqItems").alias("items")) for i, n in enumerate(names)]
    )
    wanted = candidates.select(F.inline(listed)).select("at", F.explode("items").alias("item"))
    each = F.array(*[F.struct(F.lit(i).alias("at"), F.col(n).alias("item")) for i, n in enumerate(names)])
    counted = (
        marked.select(F.inline(each))
        .join(materialised(wanted, "candidates"), ["at", "item"], "left_semi")
        .groupBy("at", "item")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    share = F.col("n") / total
    return counted.where(share > support).select(
        F.array(*[F.lit(c) for c in columns])[F.col("at")].alias("column"),
        F.when(F.col("item") != "-", F.expr("substr(item, 2)")).alias("value"),
        "n",
        share.alias("share"),
    )


BRACKET_ERROR, BRACKET_ROWS = 0.0001, 250_000


def bracketed_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    error: float = BRACKET_ERROR,
    most: int | None = None,
) -> list[list[float]]:
    """The library's quantiles without any error, for each column; none for a column without values.

    A sketch with no error keeps every value, and one task merges them all. One with a small error names two values with the
    wanted rank between them; counting tells what lies below, at and between the two. So it goes on between them, where
    few rows are left, until ``most`` are: these the sketch may keep. Equal values leave with the two ends. Each step takes
    all columns and ranks in one pass, and whatever the sketch names, the counts decide.
    """
    most = BRACKET_ROWS if most is None else most
    numbers = []
    for name in columns:
        value = F.col(name).cast("double")
        numbers.append(F.when(~F.isnan(value), value))
    sizes = df.agg(*[F.count(v) for v in numbers]).first()
    # For each wanted rank: its column, the open interval it lies in, the rank there, the rows there.
    open_ = {
        (i, j): (None, None, min(max(math.ceil(p * n), 1), n), n)
        for i, n in enumerate(sizes)
        for j, p in enumerate(probabilities)
        if n
    }
    found: dict[tuple[int, int], float] = {}

    def inside(at: tuple[int, int]) -> Column:
        value, (low, high, _, _) = numbers[at[0]], open_[at]
        above = value > low if low is not None else F.lit(True)
        return F.when(above & (value < high if high is not None else F.lit(True)), value)

    def sketch(wanted: list[tuple[int, int]], shifts: Sequence[float], allowed: float) -> list[list[float]]:
        spots = [
            min(max((open_[at][2] - 0.5) / open_[at][3] + shift, 0.0), 1.0) for at in wanted for shift in shifts
        ]
        # Ranks in the same interval of a column share a sketch.
        places = {(at[0], *open_[at][:2]): at for at in wanted}
        names = {place: f"v{k}" for k, place in enumerate(places)}
        values = df.select(*[inside(at).alias(names[place]) for place, at in places.items()])
        every = dict(zip(places, values.stat.approxQuantile(list(names.values()), spots, allowed)))
        width = len(shifts)
        return [every[at[0], *open_[at][:2]][k * width : k * width + width] for k, at in enumerate(wanted)]

    while open_:
        few = [at for at, state in open_.items() if state[3] <= most]
        many = [at for at in open_ if at not in few]
        if few:
            found.update((at, values[0]) for at, values in zip(few, sketch(few, [0.0], 0.0)))
        if many:
            ends = sketch(many, [-2 * error, 2 * error], error)
            parts = []
            for at, (a, b) in zip(many, ends):
                value = inside(at)
                parts += [F.count_if(value < a), F.count_if(value == a), F.count_if((value > a) & (value < b))]
                parts += [F.count_if((value == b) & F.lit(a < b)), F.count_if(value > b)]
            counts = list(df.agg(*[p.alias(f"n{k}") for k, p in enumerate(parts)]).first())
            for k, (at, (a, b)) in enumerate(zip(many, ends)):
                low, high, rank, _ = open_[at]
                steps = [(low, a), (a, a), (a, b), (b, b), (b, high)]
                for (start, end), held in zip(steps, counts[5 * k : 5 * k + 5]):
                    if rank <= held:
                        break
                    rank -= held
                if start is not None and start == end:
                    found[at] = start
                else:
                    open_[at] = (start, end, rank, held)
        open_ = {at: state for at, state in open_.items() if at not in found}
    return [[found[i, j] for j in range(len(probabilities)) if (i, j) in found] for i in range(len(columns))]


def sketched_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], error: float = 0.001
) -> DataFrame:
    """The library's quantiles of several columns by a sketch with a stated error, in one pass over the rows: column,
    probability, value, n and ``rank_bound``, by how many rows the rank of the value may be off. The value is always one
    that occurs; NULL and NaN are left out. With no error allowed see :func:`bracketed_quantiles`."""
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if error:
        found = df.stat.approxQuantile(columns, probabilities, error)
    else:
        found = bracketed_quantiles(df, columns, probabilities)
    rows = [(c, p, v) for c, values in zip(columns, found) for p, v in zip(probabilities, values)]
    frame = df.sparkSession.createDataFrame(rows, "column string, probability double, value double")
    sizes = F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]),
        F.array(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))) for c in columns]),
    )
    n = df.agg(sizes.alias("sizes")).scalar()[F.col("column")]
    return frame.withColumn("n", n).withColumn("rank_bound", F.ceil(F.col("n") * F.lit(float(error))))


def cross_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Contingency counts in long form, so that neither axis has to fit in a schema."""
    return df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))


def clean(
    df: DataFrame,
    missing_columns: Sequence[str] | None = V.MOSTLY_MISSING,
    truncate_mean: bool = True,
    keep: Sequence[str] = (),
    dates: Sequence[str] = ("issue_d",),
    date_pattern: str = "MM/dd/yyyy",
) -> DataFrame:
    """The full cleaning sequence for a raw loan table. The order matters.

    Numbers are read before incomplete rows are dropped, so that an unreadable one costs its row as a
    missing one does; so does an unreadable date in those of the ``dates`` that the table has.

    The balance and limit columns are dropped in the end, but are filled before incomplete rows are
    dropped: otherwise their gaps would cost rows. ``missing_columns=None`` measures which columns
    are mostly missing instead of using the known list. Columns in ``keep`` (a row key, say) pass
    through untouched and do not decide whether a row is complete.
    """
    for date in [c for c in dates if c in df.columns]:
        is_text = df.schema[date].dataType.typeName() == "string"
        df = df.where((day(date, date_pattern) if is_text else F.col(date)).isNotNull())
    df = drop_missing(df, columns=missing_columns)
    df = df.drop(*[c for c in V.IDENTIFIERS + V.TEXT_AND_CONSTANTS if c not in keep])
    df = fill_settled_balances(df)
    df = fill_mean(df, "total_rev_hi_lim", truncate=truncate_mean)
    df = cast_numbers(df, V.NUMERIC_FEATURES)
    df = drop_incomplete(df, [c for c in df.columns if c not in keep])
    df = df.withColumn("isDefault", bad_label())
    return df.drop(V.STATUS, *V.KNOWN_ONLY_AFTER_ORIGINATION)
