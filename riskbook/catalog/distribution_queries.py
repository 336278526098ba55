"""Histograms, densities, gamma fits, box statistics and intervals."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.catalog.exploration_queries import TROUBLED, sql_axis
from riskbook.catalog.registry import query
from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import troubled
from riskbook.operators import distributions as D
from riskbook.operators import intervals as I
from riskbook.operators.quantiles import FIVE_NAMES, box_stats, five_numbers
from riskbook.plans import exploration as P


def rounded(df: DataFrame, places: int, columns) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- histograms -------------------------------------------------------------------------------------


def histogram_sql(value: str, bins: int | None) -> str:
    width = "2 * (q3 - q1) * power(CAST(n AS DOUBLE), -1.0 / 3.0)"
    count = (
        f"CASE WHEN {width} > 0 THEN ceil((high - low) / ({width})) ELSE floor(sqrt(n)) END"
        if bins is None
        else str(bins)
    )
    return f"""
    WITH r AS (
        SELECT count({value}) AS n, min({value}) AS low, max({value}) AS high,
               quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3
        FROM loans
    ), s AS (
        SELECT n, low, CAST(greatest(least({count}, {bins or D.MOST_BINS}), 1) AS BIGINT) AS bins, high
        FROM r
    ), w AS (SELECT n, low, bins, (high - low) / bins AS width FROM s),
    c AS (
        SELECT least(CAST(floor(({value} - low) / width) AS BIGINT), bins - 1) AS bin, count(*) AS held,
               avg({value} - low) AS middle
        FROM loans, w GROUP BY 1
    ), a AS (SELECT unnest(range(0, bins)) AS bin, n, low, width FROM w)
    SELECT a.bin, round(low + a.bin * width, 6) AS low, round(low + (a.bin + 1) * width, 6) AS high,
           coalesce(held, 0) AS count, round(coalesce(held, 0) / (n * width), 10) AS density
    FROM a LEFT JOIN c ON c.bin = a.bin
    """


for _name, _value, _bins in (
    ("hist_amount", "loan_amnt", None),
    ("hist_rate", "int_rate", None),
    ("hist_amount_20_bins", "loan_amnt", 20),
):

    @query(_name, histogram_sql(_value, _bins))
    def _(df, value=_value, bins=_bins):
        found = D.histogram(df, value, bins)
        return rounded(rounded(found, 6, ["low", "high"]), 10, ["density"])


# --- kernel densities ---------------------------------------------------------------------------------


def shape_sql(value: str, keys: tuple[str, ...]) -> str:
    listed = "".join(f"{k}, " for k in keys)
    return f"""
        SELECT {listed} count({value}) AS n, min({value}) AS low, max({value}) AS high,
               sqrt(var_samp({value})) * power(CAST(count({value}) AS DOUBLE), -0.2) AS h
        FROM loans WHERE {value} IS NOT NULL GROUP BY {', '.join(keys) or '()'}
    """


def density_sql(value: str, keys: tuple[str, ...], points: int, fine: int = 8, cut: float = 2.0) -> str:
    listed = "".join(f"{k}, " for k in keys)
    matched = " AND ".join(f"g.{k} = b.{k}" for k in keys) or "true"
    prefixed = "".join(f"g.{k}, " for k in keys)
    return f"""
    WITH g AS (SELECT * FROM ({shape_sql(value, keys)}) WHERE h > 0),
    b AS (
        SELECT {prefixed} floor(({value} - low) / (h / {fine})) AS bin, count(*) AS held,
               avg({value} - low) AS middle
        FROM loans b JOIN g ON {matched} WHERE {value} IS NOT NULL GROUP BY {prefixed} bin
    ), p AS (
        SELECT g.*, point, point * ((high - low + 2 * {cut} * h) / {points - 1}) - {cut} * h AS spot
        FROM g, range(0, {points}) r(point)
    )
    SELECT {prefixed} CAST(g.point AS BIGINT) AS point, round(g.low + g.spot, 4) AS x,
           round(coalesce(sum(held * exp(-0.5 * power((spot - middle) / h, 2))
               / (n * h * {math.sqrt(2 * math.pi)!r})), 0), 10) AS density
    FROM p g LEFT JOIN b ON {matched} AND abs(spot - middle) <= 6 * h
    GROUP BY {prefixed} g.point, g.low, g.spot
    """


for _name, _value, _keys, _points in (
    ("kde_amount", "loan_amnt", (), 64),
    ("kde_rate", "int_rate", (), 64),
    ("kde_by_status", "loan_amnt", ("loan_status",), 32),
    ("kde_emp_length_term", "loan_amnt", ("emp_length", "term"), 32),
    ("kde_purpose_term", "loan_amnt", ("purpose", "term"), 32),
    ("kde_rate_purpose_term", "int_rate", ("purpose", "term"), 32),
):

    @query(_name, density_sql(_value, _keys, _points))
    def _(df, value=_value, keys=_keys, points=_points):
        found = D.kernel_density(df, value, keys, points=points)
        found = found.withColumn("point", F.col("point").cast("bigint"))
        return rounded(rounded(found, 4, ["x"]), 10, ["density"])


# The kernel summed over the rows themselves, with no bins, at a few points; and how far the binned curve is
# from it, as a share of the peak. One income of fifty million makes the range some hundred times wider.
_POINTS = 16
_WILD = "CASE WHEN id = (SELECT min(id) FROM loans) THEN 5e7 ELSE annual_inc END"


@query(
    "kde_against_rows",
    f"""
    WITH t AS (SELECT grade, {_WILD} AS v FROM loans WHERE annual_inc IS NOT NULL),
    g AS (
        SELECT grade, count(*) AS n, min(v) AS low, max(v) AS high,
               sqrt(var_samp(v)) * power(CAST(count(*) AS DOUBLE), -0.2) AS h
        FROM t GROUP BY 1
    ), p AS (
        SELECT g.*, point, low - 2 * h + point * ((high - low + 4 * h) / {_POINTS - 1}) AS x
        FROM g, range(0, {_POINTS}) r(point)
    )
    SELECT p.grade, CAST(point AS BIGINT) AS point, round(x, 3) AS x,
           round(sum(exp(-0.5 * power((x - v) / h, 2)) / (n * h * {math.sqrt(2 * math.pi)!r})) * 1e6, 6)
               AS direct, true AS within_one_percent
    FROM p JOIN t ON t.grade = p.grade GROUP BY p.grade, point, x
    """,
)
def _(df):
    least = df.agg(F.min("id").alias("m")).scalar()
    wild = F.when(F.col("id") == least, F.lit(5e7)).otherwise(F.col("annual_inc"))
    rows = df.select("grade", wild.alias("v")).where(F.col("annual_inc").isNotNull())
    curve = D.kernel_density(rows, "v", ["grade"], points=_POINTS)
    n = F.count("v")
    spread = rows.groupBy("grade").agg(
        n.alias("n"), (F.sqrt(F.var_samp("v")) * F.pow(n.cast("double"), F.lit(-0.2))).alias("h")
    )
    z = (F.col("x") - F.col("v")) / F.col("h")
    direct = F.sum(F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi)))
    exact = (
        curve.join(spread, "grade").join(rows, "grade")
        .groupBy("grade", "point", "x", "density").agg(direct.alias("direct"))
    )
    peak = F.max("direct").over(Window.partitionBy("grade"))
    return exact.select(
        "grade",
        F.col("point").cast("bigint").alias("point"),
        F.round("x", 3).alias("x"),
        F.round(F.col("direct") * 1e6, 6).alias("direct"),
        (F.abs(F.col("density") - F.col("direct")) < 0.01 * peak).alias("within_one_percent"),
    )


# --- gamma fits -----------------------------------------------------------------------------------------


@query(
    "gamma_sums",
    """
    SELECT grade, count(*) FILTER (loan_amnt > 2000) AS n,
           round(sum(loan_amnt - 2000) FILTER (loan_amnt > 2000), 2) AS sum_x,
           round(sum(ln(loan_amnt - 2000)) FILTER (loan_amnt > 2000), 5) AS sum_log_x,
           count(*) FILTER (loan_amnt <= 2000) AS below
    FROM loans GROUP BY 1
    """,
)
def _(df):
    sums = D.gamma_sums(df, "loan_amnt", ["grade"], location=2000.0)
    return rounded(rounded(sums, 2, ["sum_x"]), 5, ["sum_log_x"])


def newton_sql(start: str, steps: int = 12) -> str:
    """CTEs from ``start`` (n, sx, sl, tag) to ``fitted``: Newton's method as a recursive query."""
    reciprocals = " + ".join(f"1 / (a + {k})" for k in range(6))
    squares = " + ".join(f"1 / ((a + {k}) * (a + {k}))" for k in range(6))
    y = "(a + 6)"
    digamma = (
        f"ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y}**2) + 1 / (120 * {y}**4) - 1 / (252 * {y}**6)"
        f" - ({reciprocals})"
    )
    trigamma = (
        f"1 / {y} + 1 / (2 * {y}**2) + 1 / (6 * {y}**3) - 1 / (30 * {y}**5) + 1 / (42 * {y}**7)"
        f" + {squares}"
    )
    return f"""
    s AS (SELECT tag, n, sx, sl, ln(sx / n) - sl / n AS s FROM {start}),
    newton AS (
        SELECT 0 AS step, tag, n, sx, sl, s, (3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s) AS a
        FROM s
        UNION ALL
        SELECT step + 1, tag, n, sx, sl, s,
               a - (ln(a) - ({digamma}) - s) / (1 / a - ({trigamma})) AS a
        FROM newton WHERE step < {steps}
    ), fitted AS (
        SELECT tag, n, a AS shape, sx / n / a AS scale,
               (a - 1) * sl - sx / (sx / n / a) - n * (a * ln(sx / n / a) + lgamma(a)) AS log_likelihood
        FROM newton WHERE step = {steps}
    )
    """


def gamma_sql(value: str) -> str:
    """The log-likelihood uses the engine's own lgamma."""
    return f"""
    WITH RECURSIVE t AS (
        SELECT 0 AS tag, count(*) FILTER ({value} > 0) AS n, sum({value}) FILTER ({value} > 0) AS sx,
               sum(ln({value})) FILTER ({value} > 0) AS sl FROM loans
    ), {newton_sql("t")}
    SELECT n, round(shape, 6) AS shape, round(scale, 4) AS scale, round(log_likelihood, 2) AS log_likelihood,
           (SELECT count(*) FROM loans WHERE {value} <= 0) AS below
    FROM fitted
    """


for _name, _value in (("gamma_fit_amount", "loan_amnt"), ("gamma_fit_rate", "int_rate")):

    @query(_name, gamma_sql(_value))
    def _(df, value=_value):
        fit = D.gamma_fit(df, value)
        fit = rounded(fit, 6, ["shape"])
        return rounded(rounded(fit, 4, ["scale"]), 2, ["log_likelihood"])


def gamma_location_sql(value: str) -> str:
    """The same candidates, each with sums over all rows."""
    gaps = ", ".join(repr(g) for g in D.LOCATION_GAPS)
    return f"""
    WITH RECURSIVE e AS (SELECT min({value}) AS low, max({value}) AS high FROM loans),
    c AS (SELECT low - gap * (high - low) AS tag FROM e, (SELECT unnest([{gaps}]::DOUBLE[]) AS gap)),
    t AS (SELECT tag, count(*) AS n, sum({value} - tag) AS sx, sum(ln({value} - tag)) AS sl FROM loans, c GROUP BY 1),
    {newton_sql("t")}
    SELECT n, round(tag, 6) AS location, round(shape, 4) AS shape, round(scale, 4) AS scale,
           round(log_likelihood, 1) AS log_likelihood
    FROM fitted ORDER BY fitted.log_likelihood DESC LIMIT 1
    """


for _name, _value in (("gamma_location_rate", "int_rate"), ("gamma_location_dti", "dti")):

    @query(_name, gamma_location_sql(_value))
    def _(df, value=_value):
        fit = D.gamma_fit_location(df, value, refine=False)
        fit = rounded(rounded(fit, 6, ["location"]), 4, ["shape", "scale"])
        return rounded(fit, 1, ["log_likelihood"])


# --- five numbers and boxes ---------------------------------------------------------------------------


def five_sql(value: str, keys: tuple[str, ...] = (), where: str = "true") -> str:
    listed = "".join(f"{k}, " for k in keys)
    grouped = f"GROUP BY {', '.join(keys)}" if keys else ""
    return f"""
        SELECT {listed} count({value}) AS n, min({value}) AS low,
               quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
               quantile_cont({value}, 0.75) AS q3, max({value}) AS high
        FROM loans WHERE {where} AND {value} IS NOT NULL {grouped}
    """


def box_sql(value: str, keys: tuple[str, ...] = (), where: str = "true") -> str:
    listed = "".join(f"f.{k}, " for k in keys)
    matched = " AND ".join(f"l.{k} = f.{k}" for k in keys) or "true"
    inside = f"l.{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
    WITH f AS ({five_sql(value, keys, where)})
    SELECT {listed} f.n, f.low, round(f.q1, 6) AS q1, round(f.median, 6) AS median,
           round(f.q3, 6) AS q3, f.high,
           min(l.{value}) FILTER ({inside}) AS whisker_low,
           max(l.{value}) FILTER ({inside}) AS whisker_high,
           count(*) FILTER (NOT ({inside})) AS outliers
    FROM loans l JOIN f ON {matched}
    WHERE {where} AND l.{value} IS NOT NULL
    GROUP BY {listed} f.n, f.low, f.q1, f.median, f.q3, f.high
    """


def ordered_box_sql(value: str, key: str, order, where: str = "true") -> str:
    return f"""
    SELECT axis.rank, axis.label AS {key}, coalesce(b.n, 0) AS n, b.low, b.q1, b.median, b.q3, b.high,
           b.whisker_low, b.whisker_high, coalesce(b.outliers, 0) AS outliers
    FROM {sql_axis(order)} LEFT JOIN ({box_body_sql(value, key, where)}) b ON b.{key} = axis.label
    """


def box_body_sql(value: str, key: str, where: str) -> str:
    return box_sql(value, (key,), where)


QUARTILE_COLUMNS = ("q1", "median", "q3")


def as_doubles(df: DataFrame) -> DataFrame:
    return rounded(df, 6, QUARTILE_COLUMNS)


for _name, _value, _keys in (
    ("five_number_amount", "loan_amnt", ()),
    ("five_number_rate", "int_rate", ()),
    ("five_number_income_by_grade", "annual_inc", ("grade",)),
):

    @query(
        _name,
        f"SELECT * REPLACE (round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3)"
        f" FROM ({five_sql(_value, _keys)})",
    )
    def _(df, value=_value, keys=_keys):
        return as_doubles(five_numbers(df, value, keys))


for _name, _value, _keys in (
    ("box_amount", "loan_amnt", ()),
    ("box_status_total_acc", "total_acc", ("loan_status",)),
    ("box_subgrade_amount", "loan_amnt", ("sub_grade", "grade")),
    ("box_subgrade_rate", "int_rate", ("sub_grade", "grade")),
    ("whiskers_by_grade", "installment", ("grade",)),
):
    # a thin lower whisker range makes outliers: reach is the usual 1.5
    _cast = (
        box_sql(_value, _keys)
        if _value != "total_acc"
        else f"SELECT * REPLACE (CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high,"
        f" CAST(whisker_low AS DOUBLE) AS whisker_low, CAST(whisker_high AS DOUBLE) AS whisker_high)"
        f" FROM ({box_sql(_value, _keys)})"
    )

    @query(_name, _cast)
    def _(df, value=_value, keys=_keys):
        return as_doubles(box_stats(df, value, keys))


# Epoch seconds crowd in a few slices of the number line; a low bound has the wanted ones cut again.
EPOCH = "(datediff('day', DATE '1970-01-01', issue_d) * 86400 + total_acc * 1300 + dti * 7)"


def with_epoch(df: DataFrame) -> DataFrame:
    seconds = F.datediff("issue_d", F.lit("1970-01-01").cast("date")) * 86400 + F.col("total_acc") * 1300
    return df.withColumn("epoch", seconds + F.col("dti") * 7)


def of_epochs(sql: str) -> str:
    return sql.replace("FROM loans", f"FROM (SELECT *, CAST({EPOCH} AS DOUBLE) AS epoch FROM loans)")


@query(
    "five_number_epoch_by_grade",
    "SELECT * REPLACE (round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3)"
    f" FROM ({of_epochs(five_sql('epoch', ('grade',)))})",
)
def _(df):
    return as_doubles(five_numbers(with_epoch(df), "epoch", ["grade"], most=100))


@query("box_epoch_by_grade", of_epochs(box_sql("epoch", ("grade",))))
def _(df):
    return as_doubles(box_stats(with_epoch(df), "epoch", ["grade"], most=100))


@query("box_emp_length_rate", ordered_box_sql("int_rate", "emp_length", V.EMP_LENGTH_ORDER))
def _(df):
    return as_doubles(P.rate_by_employment(df))


for _name, _value in (("amount", "loan_amnt"), ("rate", "int_rate")):

    @query(
        f"box_default_emp_{_name}",
        ordered_box_sql(_value, "emp_length", V.EMP_LENGTH_ORDER, TROUBLED),
    )
    def _(df, value=_value):
        return as_doubles(P.box_of_troubled_by_employment(P.prepare(df), value))


# Squared amounts have a long right tail, so that whiskers stop short and outliers are counted.
@query(
    "outliers_by_grade",
    f"""
    WITH q AS (
        SELECT grade, quantile_cont(loan_amnt * loan_amnt / 1e5 * int_rate, 0.25) AS q1,
               quantile_cont(loan_amnt * loan_amnt / 1e5 * int_rate, 0.75) AS q3
        FROM loans GROUP BY 1
    )
    SELECT l.grade, count(*) AS n, count(*) FILTER (
        NOT (loan_amnt * loan_amnt / 1e5 * int_rate
             BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
    FROM loans l JOIN q ON q.grade = l.grade GROUP BY 1
    """,
)
def _(df):
    burden = F.col("loan_amnt") * F.col("loan_amnt") / F.lit(1e5) * F.col("int_rate")
    boxes = box_stats(df.withColumn("burden", burden), "burden", ["grade"])
    return boxes.select("grade", "n", "outliers")


# --- intervals ----------------------------------------------------------------------------------------

_MEAN = "CAST(sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS DOUBLE) / count(loan_amnt)"
_HALF = "1.96 * stddev_samp(loan_amnt) / sqrt(count(loan_amnt))"

for _name, _keys, _statistic in (
    ("mean_ci", ("sub_grade",), "mean"),
    ("sum_ci", ("term", "loan_status"), "sum"),
):
    _factor = "count(loan_amnt)" if _statistic == "sum" else "1"

    @query(
        _name,
        f"""
        SELECT {', '.join(_keys)}, count(loan_amnt) AS n, round({_MEAN} * {_factor}, 3) AS estimate,
               round(({_MEAN} - {_HALF}) * {_factor}, 3) AS low,
               round(({_MEAN} + {_HALF}) * {_factor}, 3) AS high
        FROM loans WHERE {TROUBLED} GROUP BY {', '.join(_keys)}
        """,
    )
    def _(df, keys=_keys, statistic=_statistic):
        found = I.normal_interval(df.where(troubled()), keys, "loan_amnt", statistic)
        return rounded(found, 3, ["estimate", "low", "high"])


def bootstrap_sql(key: str, statistic: str, replicates: int, buckets: int) -> str:
    steps, total = [], 0.0
    for k in range(12):
        total += math.exp(-1) / math.factorial(k)
        steps.append(f"CAST(u >= {total!r} AS INTEGER)")
    total = "CAST(sum(w * s) AS DOUBLE)"
    estimate = f"{total} / sum(w * n)" + (" * sum(n)" if statistic == "sum" else "")
    return f"""
    WITH b AS (
        SELECT {key}, CAST('0x' || substr(md5(id || '|1395'), 1, 8) AS BIGINT) % {buckets} AS bucket,
               count(*) AS n, sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS s
        FROM loans GROUP BY 1, 2
    ), d AS (
        SELECT {key}, replicate, n, s,
               CAST('0x' || substr(md5({key} || '|' || bucket || '|' || replicate || '|1395'), 1, 8)
                    AS BIGINT) / 4294967296.0::DOUBLE AS u
        FROM b, range(0, {replicates}) r(replicate)
    ), w AS (SELECT {key}, replicate, n, s, {' + '.join(steps)} AS w FROM d),
    e AS (SELECT {key}, replicate, {estimate} AS estimate FROM w GROUP BY 1, 2)
    SELECT {key}, count(estimate) AS replicates, round(quantile_cont(estimate, 0.025), 3) AS low,
           round(quantile_cont(estimate, 0.975), 3) AS high
    FROM e GROUP BY 1
    """


# With 81 replicates both tails fall on a replicate, so that neither side interpolates.
for _name, _key, _statistic in (
    ("bootstrap_mean_ci", "grade", "mean"),
    ("bootstrap_sum_ci", "loan_status", "sum"),
):

    @query(_name, bootstrap_sql(_key, _statistic, 81, 64))
    def _(df, key=_key, statistic=_statistic):
        found = I.bootstrap_interval(
            df, [key], "loan_amnt", ["id"], statistic, replicates=81, buckets=64
        )
        return rounded(found, 3, ["low", "high"])


# The resampled interval of the sum against the closed form, which knows nothing of buckets.
@query(
    "bootstrap_sum_width",
    """
    SELECT loan_status, count(loan_amnt) AS n,
           round(1.96 * stddev_samp(loan_amnt) * sqrt(count(loan_amnt)), 2) AS half_width,
           true AS within_fifth
    FROM loans GROUP BY 1
    """,
)
def _(df):
    drawn = I.bootstrap_interval(df, ["loan_status"], "loan_amnt", ["id"], "sum", replicates=600)
    closed = I.normal_interval(df, ["loan_status"], "loan_amnt", "sum")
    half = (F.col("c.high") - F.col("c.low")) / 2
    return closed.alias("c").join(drawn.alias("d"), "loan_status").select(
        "loan_status",
        F.col("c.n").alias("n"),
        F.round(half, 2).alias("half_width"),
        (F.abs((F.col("d.high") - F.col("d.low")) / 2 / half - 1) < 0.2).alias("within_fifth"),
    )
