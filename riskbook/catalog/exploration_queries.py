"""Counts, sums, medians and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.registry import query
from riskbook.functions import expressions as E
from riskbook.functions import vocabulary as V
from riskbook.operators import aggregates as A
from riskbook.operators.lookup import attach, materialised
from riskbook.operators.quantiles import median
from riskbook.plans import exploration as P
from riskbook.sources.tables import preview, register_view


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def sql_bins(column: str, edges, labels, other) -> str:
    cases = " ".join(
        f"WHEN {column} >= {low} AND {column} < {high} THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels)
    )
    return f"CASE {cases} ELSE '{other}' END"


def sql_axis(order) -> str:
    """A (rank, label) table of a fixed order."""
    return "(VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(order)) + ") axis(rank, label)"


QUARTER = "(year(issue_d) || 'Q' || quarter(issue_d))"
INCOME = sql_bins("annual_inc", V.INCOME_EDGES, V.INCOME_RANGES, V.INCOME_OTHER)
RATE = sql_bins("int_rate", V.RATE_EDGES, V.RATE_RANGES, V.RATE_OTHER)
TROUBLED = f"loan_status IN ({sql_list(V.TROUBLED)})"
BAD = f"CASE WHEN loan_status IN ({sql_list(V.LABELLED_BAD)}) THEN 1 ELSE 0 END"
AMOUNT = "CAST(sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS DOUBLE)"


# --- over time --------------------------------------------------------------------------------------


@query(
    "loans_per_quarter",
    f"SELECT {QUARTER} AS issue_year, count(*) AS n FROM loans GROUP BY 1 ORDER BY 1",
)
def _(df: DataFrame) -> DataFrame:
    return P.loans_per_quarter(P.prepare(df))


@query(
    "amount_by_issue_date",
    f"SELECT CAST(issue_d AS VARCHAR) AS issue_date, {AMOUNT} AS sum_loan_amnt FROM loans GROUP BY 1",
)
def _(df):
    return P.amount_per_issue_date(P.prepare(df)).select(
        F.col("issue_d_dateType").cast("string").alias("issue_date"), "sum_loan_amnt"
    )


for _value, _name in (("loan_amnt", "amount"), ("int_rate", "rate")):

    @query(
        f"median_{_name}_by_quarter",
        f"SELECT {QUARTER} AS issue_year, quantile_disc({_value}, 0.5) AS median_{_value}"
        " FROM loans GROUP BY 1 ORDER BY 1",
    )
    def _(df, value=_value):
        return P.median_per_quarter(P.prepare(df), value, "lower")

    # The sketch promises a rank within 1/accuracy of the middle, so that is what is compared.
    @query(
        f"sketch_median_{_name}_by_quarter",
        f"SELECT {QUARTER} AS issue_year, count(*) AS n, 1 AS within_bound FROM loans GROUP BY 1",
    )
    def _(df, value=_value, accuracy=1000):
        prepared = P.prepare(df)
        sketch = P.median_per_quarter_sql(prepared, value, accuracy)
        slack = F.col("n") / accuracy + 1
        ranked = (
            attach(prepared, materialised(sketch), ["issue_year"], [f"median_{value}"])
            .groupBy("issue_year")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col(value) < F.col(f"median_{value}")).alias("below"),
                F.count_if(F.col(value) <= F.col(f"median_{value}")).alias("upto"),
            )
        )
        return ranked.select(
            "issue_year",
            "n",
            (
                (F.col("below") <= F.col("n") / 2 + slack) & (F.col("upto") >= F.col("n") / 2 - slack)
            ).cast("int").alias("within_bound"),
        )


@query(
    "issue_dates_from_text",
    """
    WITH texts AS (
        SELECT CASE WHEN issue_d < DATE '1996-01-01' THEN strftime(issue_d, '%b-%Y')
                    ELSE strftime(issue_d, '%m/%d/%Y') END AS text
        FROM loans
    ), days AS (SELECT CAST(try_strptime(text, '%m/%d/%Y') AS DATE) AS day FROM texts)
    SELECT CASE WHEN day IS NULL THEN 'unreadable' ELSE year(day) || 'Q' || quarter(day) END AS quarter,
           count(*) AS n, CAST(min(day) AS VARCHAR) AS first_day
    FROM days GROUP BY 1
    """,
)
def _(df):
    text = F.when(
        F.col("issue_d") < F.lit("1996-01-01").cast("date"), F.date_format("issue_d", "MMM-yyyy")
    ).otherwise(F.date_format("issue_d", "MM/dd/yyyy"))
    days = df.select(text.alias("text")).select(E.day("text").alias("day"))
    return days.groupBy(
        F.coalesce(E.quarter_label("day"), F.lit("unreadable")).alias("quarter")
    ).agg(F.count(F.lit(1)).alias("n"), F.min("day").cast("string").alias("first_day"))


@query(
    "issue_instants_from_text",
    """
    SELECT count(try_strptime(strftime(issue_d, '%m/%d/%Y') || ' 06:30:00', '%m/%d/%Y %H:%M:%S'))
               AS readable,
           count(DISTINCT issue_d) AS days
    FROM loans
    """,
)
def _(df):
    text = F.concat(F.date_format("issue_d", "MM/dd/yyyy"), F.lit(" 06:30:00"))
    return df.select(E.instant(text).alias("at")).groupBy("at").agg(
        F.count("at").alias("n")
    ).agg(F.sum("n").alias("readable"), F.count("at").alias("days"))


# --- by status --------------------------------------------------------------------------------------


@query(
    "status_counts_desc",
    "SELECT loan_status, count(*) AS n FROM loans GROUP BY 1 ORDER BY n DESC, loan_status",
)
def _(df):
    return P.status_counts(df)


@query(
    "default_by_verification",
    "SELECT verification_status, count(*) AS n FROM loans WHERE loan_status = 'Default' GROUP BY 1",
)
def _(df):
    return P.defaults_by_verification(df)


@query(
    "amount_by_status",
    f"SELECT loan_status, {AMOUNT} AS sum_loan_amnt FROM loans GROUP BY 1",
)
def _(df):
    return P.amount_per_status(df)


@query(
    "describe_status",
    """
    WITH c AS (SELECT loan_status, count(*) AS n FROM loans GROUP BY 1)
    SELECT CAST(sum(n) AS BIGINT) AS count, count(*) AS unique,
           (SELECT loan_status FROM c ORDER BY n DESC, loan_status LIMIT 1) AS top,
           max(n) AS freq
    FROM c
    """,
)
def _(df):
    return A.describe_text(df, "loan_status")


# --- by state ---------------------------------------------------------------------------------------


@query("amount_by_state", f"SELECT addr_state, {AMOUNT} AS sum_loan_amnt FROM loans GROUP BY 1")
def _(df):
    return P.amount_per_state(df)


@query(
    "median_rate_by_state",
    "SELECT addr_state, quantile_disc(int_rate, 0.5) AS median_int_rate FROM loans GROUP BY 1",
)
def _(df):
    return P.median_rate_per_state(df, "lower")


@query(
    "max_rate_by_state", "SELECT addr_state, max(int_rate) AS max_int_rate FROM loans GROUP BY 1"
)
def _(df):
    register_view(df, "loans_by_state")
    return df.sparkSession.sql(
        "SELECT addr_state, max(int_rate) AS max_int_rate FROM loans_by_state GROUP BY addr_state"
    )


@query(
    "min_rate_by_state", "SELECT addr_state, min(int_rate) AS min_int_rate FROM loans GROUP BY 1"
)
def _(df):
    return P.min_rate_per_state(df)


# --- bins -------------------------------------------------------------------------------------------


@query(
    "income_bin_status_counts",
    f"SELECT {INCOME} AS annual_inc_range, loan_status, count(*) AS n FROM loans GROUP BY 1, 2",
)
def _(df):
    return A.count_per(P.prepare(df), ["annual_inc_range", "loan_status"])


@query(
    "income_bin_status_amount",
    f"""
    SELECT {INCOME} AS annual_inc_range, loan_status, count(*) AS n, {AMOUNT} AS sum_loan_amnt
    FROM loans GROUP BY 1, 2
    """,
)
def _(df):
    return P.income_by_status(P.prepare(df))


@query(
    "rate_bins",
    f"""
    WITH c AS (SELECT {RATE} AS int_rate_range, count(*) AS n FROM loans GROUP BY 1)
    SELECT axis.rank, axis.label AS int_rate_range, coalesce(c.n, 0) AS n
    FROM {sql_axis(V.RATE_ORDER)} LEFT JOIN c ON c.int_rate_range = axis.label
    """,
)
def _(df):
    counted = A.count_per(P.prepare(df), "int_rate_range")
    return A.in_fixed_order(counted, "int_rate_range", V.RATE_ORDER, ["n"])


@query(
    "income_bins_of_loans",
    f"SELECT id, annual_inc, {INCOME} AS annual_inc_range, {RATE} AS int_rate_range FROM loans",
)
def _(df):
    return P.prepare(df).select("id", "annual_inc", "annual_inc_range", "int_rate_range")


@query(
    "emp_length_ordinal",
    """
    SELECT emp_length,
           CASE emp_length WHEN 'n/a' THEN 0 WHEN '< 1 year' THEN 0 WHEN '10+ years' THEN 10
                ELSE CAST(split_part(emp_length, ' ', 1) AS INTEGER) END AS emp_lengthIndex,
           count(*) AS n
    FROM loans GROUP BY 1, 2
    """,
)
def _(df):
    coded = df.select("emp_length", E.employment_years().alias("emp_lengthIndex"))
    return coded.groupBy("emp_length", "emp_lengthIndex").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ordered_emp_length",
    f"""
    WITH c AS (SELECT emp_length, count(*) AS n FROM loans GROUP BY 1)
    SELECT axis.rank, axis.label AS emp_length, coalesce(c.n, 0) AS n
    FROM {sql_axis(V.EMP_LENGTH_ORDER)} LEFT JOIN c ON c.emp_length = axis.label
    """,
)
def _(df):
    return A.in_fixed_order(
        A.count_per(df, "emp_length"), "emp_length", V.EMP_LENGTH_ORDER, ["n"]
    )


YEARS_OF_TEN = tuple(f"{n} years" for n in range(2, 10))


@query(
    "ordered_with_remainder",
    f"""
    WITH c AS (SELECT CASE WHEN total_acc % 7 = 0 THEN NULL ELSE emp_length END AS emp_length, count(*) AS n
               FROM loans GROUP BY 1)
    SELECT axis.rank, axis.label AS emp_length, coalesce(c.n, 0) AS n
    FROM {sql_axis(YEARS_OF_TEN)} LEFT JOIN c ON c.emp_length = axis.label
    UNION ALL
    SELECT {len(YEARS_OF_TEN)}, emp_length, n FROM c
    WHERE emp_length IS NULL OR emp_length NOT IN ({sql_list(YEARS_OF_TEN)})
    """,
)
def _(df):
    """Values that the order does not name, and NULL, follow behind it."""
    gaps = df.withColumn("emp_length", F.when(F.col("total_acc") % 7 != 0, F.col("emp_length")))
    counted = A.count_per(gaps, "emp_length")
    return A.in_fixed_order(counted, "emp_length", YEARS_OF_TEN, ["n"], outside=True)


@query(
    "category_codes",
    """
    WITH g AS (SELECT sub_grade, grade, count(*) AS n FROM loans GROUP BY 1, 2)
    SELECT sub_grade, CAST(dense_rank() OVER (ORDER BY sub_grade) - 1 AS BIGINT) AS sub_grade_code,
           CAST(dense_rank() OVER (ORDER BY grade) - 1 AS BIGINT) AS grade_code, n
    FROM g
    """,
)
def _(df):
    coded = df.select(
        "sub_grade",
        A.category_codes(df, "sub_grade", V.SUB_GRADE_ORDER).cast("bigint").alias("sub_grade_code"),
        A.category_codes(df, "grade", V.GRADE_ORDER).cast("bigint").alias("grade_code"),
    )
    return coded.groupBy("sub_grade", "sub_grade_code", "grade_code").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("purpose_counts", "SELECT purpose, count(*) AS n FROM loans GROUP BY 1")
def _(df):
    return P.purpose_counts(df)


# --- defaulted loans --------------------------------------------------------------------------------


@query(
    "defaulted_projection",
    f"""
    SELECT {INCOME} AS annual_inc_range, loan_amnt, emp_length, int_rate, sub_grade,
           {RATE} AS int_rate_range
    FROM loans WHERE {TROUBLED}
    """,
)
def _(df):
    register_view(P.prepare(df), "prepared_loans")
    return df.sparkSession.sql(
        f"""
        SELECT annual_inc_range, loan_amnt, emp_length, int_rate, sub_grade, int_rate_range
        FROM prepared_loans WHERE loan_status IN ({sql_list(V.TROUBLED)})
        """
    )


for _name, _key, _order, _expression in (
    ("income", "annual_inc_range", V.INCOME_ORDER, INCOME),
    ("subgrade", "sub_grade", V.SUB_GRADE_ORDER, "sub_grade"),
    ("rate_bin", "int_rate_range", V.RATE_ORDER, RATE),
):

    @query(
        f"mean_default_by_{_name}",
        f"""
        WITH c AS (
            SELECT {_expression} AS k, count(loan_amnt) AS n, {AMOUNT} / count(loan_amnt) AS m
            FROM loans WHERE {TROUBLED} GROUP BY 1
        )
        SELECT axis.rank, axis.label AS {_key}, coalesce(c.n, 0) AS n,
               round(c.m, 6) AS mean_loan_amnt
        FROM {sql_axis(_order)} LEFT JOIN c ON c.k = axis.label
        """,
    )
    def _(df, key=_key, order=_order):
        means = P.mean_amount_of_troubled(P.prepare(df), key, order)
        return means.withColumn("mean_loan_amnt", F.round("mean_loan_amnt", 6))


# --- small building blocks ----------------------------------------------------------------------------


@query("distinct_grades", "SELECT DISTINCT grade FROM loans")
def _(df):
    return A.distinct_values(df, "grade")


@query(
    "largest_loans",
    "SELECT id, loan_amnt, grade FROM loans ORDER BY loan_amnt DESC, id LIMIT 20",
)
def _(df):
    return preview(df.select("id", "loan_amnt", "grade"), [F.desc("loan_amnt"), "id"], 20)


@query(
    "overall_counts",
    """
    SELECT count(*) AS total,
           count(*) FILTER (loan_status = 'Fully Paid') AS fully_paid,
           count(*) FILTER (int_rate >= 10 AND int_rate < 20) AS middle_rates,
           count(*) FILTER (NOT (term = '36 months')) AS long_terms,
           count(*) FILTER (grade = 'A' AND home_ownership = 'RENT') AS renters_in_a,
           count(*) FILTER (annual_inc IS NULL OR isnan(annual_inc)) AS no_income
    FROM loans
    """,
)
def _(df):
    return A.tally(
        df,
        {
            "fully_paid": F.col("loan_status") == V.FULLY_PAID,
            "middle_rates": E.between_half_open("int_rate", 10, 20),
            "long_terms": ~(F.col("term") == "36 months"),
            "renters_in_a": (F.col("grade") == "A") & (F.col("home_ownership") == "RENT"),
            "no_income": E.missing(df, "annual_inc"),
        },
    )


@query(
    "chained_filters",
    """
    SELECT grade, count(*) AS n FROM loans
    WHERE loan_status IN ('Fully Paid', 'Charged Off') AND int_rate >= 10 AND int_rate < 20
      AND NOT (term = '36 months') AND tot_cur_bal IS NOT NULL
    GROUP BY 1
    """,
)
def _(df):
    kept = (
        df.where(F.col("loan_status").isin(*V.SETTLED))
        .where(E.between_half_open("int_rate", 10, 20))
        .where(~(F.col("term") == "36 months"))
        .where(F.col("tot_cur_bal").isNotNull())
    )
    return A.count_per(kept, "grade")


@query(
    "tolerant_casts",
    "SELECT id, TRY_CAST(raw_amount AS DOUBLE) AS amount, CAST(total_acc AS DOUBLE) AS total_acc"
    " FROM loans",
)
def _(df):
    cast = E.cast_numbers(df, ["raw_amount", "total_acc"])
    return cast.select("id", F.col("raw_amount").alias("amount"), "total_acc")


@query(
    "cast_list",
    """
    SELECT count(loan_amnt) AS loan_amnt, count(int_rate) AS int_rate, count(annual_inc) AS annual_inc,
           count(total_acc) AS total_acc, count(TRY_CAST(raw_amount AS DOUBLE)) AS raw_amount,
           CAST(sum(CAST(TRY_CAST(raw_amount AS DOUBLE) AS DECIMAL(18, 2))) AS DOUBLE) AS raw_total
    FROM loans
    """,
)
def _(df):
    columns = [*P.MEASURES, "raw_amount"]
    cast = E.cast_numbers(E.cast_numbers(df, V.NUMERIC_FEATURES), columns)
    return cast.agg(
        *[F.count(c).alias(c) for c in columns], A.money_sum("raw_amount").alias("raw_total")
    )


@query(
    "mean_of_text",
    """
    SELECT round(CAST(sum(CAST(TRY_CAST(raw_amount AS DOUBLE) AS DECIMAL(18, 2))) AS DOUBLE)
                 / count(TRY_CAST(raw_amount AS DOUBLE)), 6) AS mean_raw_amount,
           CAST(trunc(avg(TRY_CAST(raw_amount AS DOUBLE))) AS BIGINT) AS whole
    FROM loans
    """,
)
def _(df):
    mean = A.mean_of_text(df, "raw_amount", scale=2)
    return mean.select(
        F.round("mean_raw_amount", 6).alias("mean_raw_amount"),
        F.col("mean_raw_amount").cast("bigint").alias("whole"),
    )


@query(
    "renamed_projection",
    """
    SELECT grade AS loan_grade, CASE WHEN term = '36 months' THEN 1 ELSE 0 END AS short_term,
           count(*) AS loans_held
    FROM loans GROUP BY 1, 2
    """,
)
def _(df):
    wide = df.select("*", F.when(F.col("term") == "36 months", 1).otherwise(0).alias("short_term"))
    slim = wide.withColumnRenamed("grade", "loan_grade").drop("id", "issue_d", "no_such_column")
    counted = slim.groupBy("loan_grade", "short_term").count()
    return counted.toDF("loan_grade", "short_term", "loans_held")


@query(
    "exact_median_amount",
    "SELECT grade, quantile_disc(loan_amnt, 0.5) AS median_loan_amnt FROM loans GROUP BY 1",
)
def _(df):
    return median(df, "loan_amnt", ["grade"])
