"""Missing values: profiles, fills, drops and the whole cleaning sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.distribution_queries import rounded
from riskbook.catalog.exploration_queries import BAD
from riskbook.catalog.loans import LOAN_COLUMNS
from riskbook.catalog.registry import query
from riskbook.functions import vocabulary as V
from riskbook.operators import cleaning as C
from riskbook.operators.aggregates import money_sum
from riskbook.plans import exploration as P
from riskbook.plans.training import model_table

PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls,"
    f" (count(*) - count({c})) / count(*)::DOUBLE AS null_ratio FROM loans"
    for c in LOAN_COLUMNS
)


@query("null_profile", PROFILE)
def _(df: DataFrame) -> DataFrame:
    return C.null_profile(df)


@query("missing_over_half", f"SELECT * FROM ({PROFILE}) WHERE nulls > 0.5 * rows")
def _(df):
    return C.over_threshold(C.null_profile(df))


@query(
    "drop_mostly_missing",
    """
    SELECT grade, count(*) AS n, count(half_missing) AS half_missing
    FROM loans GROUP BY 1
    """,
)
def _(df):
    kept = C.drop_missing(df)
    if "mths_since_last_delinq" in kept.columns:
        raise AssertionError("a mostly missing column was kept")
    return kept.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"), F.count("half_missing").alias("half_missing")
    )


@query(
    "fill_conditional_zero",
    """
    SELECT loan_status,
           count(CASE WHEN tot_cur_bal IS NULL AND loan_status IN ('Fully Paid', 'Charged Off')
                      THEN 0 ELSE tot_cur_bal END) AS filled,
           count(*) FILTER (tot_cur_bal IS NULL AND loan_status IN ('Fully Paid', 'Charged Off'))
               AS zeros,
           CAST(sum(CAST(coalesce(tot_coll_amt, 0) AS DECIMAL(18, 2))) AS DOUBLE) AS tot_coll_amt
    FROM loans GROUP BY 1
    """,
)
def _(df):
    filled = C.fill_settled_balances(df)
    return filled.groupBy("loan_status").agg(
        F.count("tot_cur_bal").alias("filled"),
        F.count_if(F.col("tot_cur_bal") == 0).alias("zeros"),
        F.coalesce(money_sum("tot_coll_amt"), F.lit(0.0)).alias("tot_coll_amt"),
    )


@query(
    "fill_mean",
    """
    WITH m AS (SELECT trunc(avg(total_rev_hi_lim)) AS mean FROM loans)
    SELECT grade, count(*) AS n,
           CAST(sum(CAST(coalesce(total_rev_hi_lim, mean) AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM loans, m GROUP BY 1
    """,
)
def _(df):
    filled = C.fill_mean(df, "total_rev_hi_lim")
    return filled.groupBy("grade").agg(
        F.count("total_rev_hi_lim").alias("n"), money_sum("total_rev_hi_lim").alias("total")
    )


@query(
    "dropna_any",
    """
    SELECT loan_status, count(*) AS n FROM loans
    WHERE annual_inc IS NOT NULL AND tot_cur_bal IS NOT NULL AND half_missing IS NOT NULL
    GROUP BY 1
    """,
)
def _(df):
    kept = C.drop_incomplete(df, ["annual_inc", "tot_cur_bal", "half_missing"])
    return kept.groupBy("loan_status").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cleaned_loans",
    f"""
    SELECT {BAD} AS isDefault, grade, count(*) AS n,
           CAST(sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS DOUBLE) AS loan_amnt,
           CAST(sum(CAST(annual_inc AS DECIMAL(18, 2))) AS DOUBLE) AS annual_inc
    FROM loans
    WHERE annual_inc IS NOT NULL AND half_missing IS NOT NULL
      AND (tot_cur_bal IS NOT NULL OR loan_status IN ('Fully Paid', 'Charged Off'))
    GROUP BY 1, 2
    """,
)
def _(df):
    cleaned = C.clean(df)
    dropped = {*V.IDENTIFIERS, *V.MOSTLY_MISSING, *V.KNOWN_ONLY_AFTER_ORIGINATION, V.STATUS}
    if dropped & set(cleaned.columns):
        raise AssertionError("cleaning kept a column it should drop")
    return cleaned.groupBy("isDefault", "grade").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("loan_amnt").alias("loan_amnt"),
        money_sum("annual_inc").alias("annual_inc"),
    )


@query(
    "impute_mean",
    """
    WITH m AS (SELECT avg(annual_inc) AS mean FROM loans)
    SELECT grade, count(*) AS n, round(avg(coalesce(annual_inc, mean)), 4) AS mean_income
    FROM loans, m GROUP BY 1
    """,
)
def _(df):
    filled = C.impute(df, ["annual_inc"])
    return filled.groupBy("grade").agg(
        F.count("annual_inc_imputed").alias("n"),
        F.round(F.avg("annual_inc_imputed"), 4).alias("mean_income"),
    )


@query(
    "pair_statistics",
    """
    SELECT 'loan_amnt' AS "left", 'int_rate' AS "right",
           round(covar_samp(loan_amnt, int_rate), 4) AS covariance,
           round(corr(loan_amnt, int_rate), 8) AS correlation FROM loans
    UNION ALL
    SELECT 'loan_amnt', 'annual_inc', round(covar_samp(loan_amnt, annual_inc), 0),
           round(corr(loan_amnt, annual_inc), 8) FROM loans
    """,
)
def _(df):
    found = C.pair_statistics(df, [("loan_amnt", "int_rate"), ("loan_amnt", "annual_inc")])
    places = F.when(F.col("right") == "annual_inc", F.round("covariance", 0)).otherwise(
        F.round("covariance", 4)
    )
    return rounded(found, 8, ["correlation"]).withColumn("covariance", places)


@query(
    "grade_by_ownership",
    "SELECT grade, home_ownership, count(*) AS n FROM loans GROUP BY 1, 2",
)
def _(df):
    return C.cross_counts(df, "grade", "home_ownership")


FREQUENT = ("sub_grade", "purpose", "addr_state", "loan_amnt", "annual_inc")


@query(
    "frequent_items",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", {"CAST(CAST(annual_inc AS BIGINT) AS VARCHAR) || '.0'" if c == "annual_inc" else f"CAST({c} AS VARCHAR)"}
                   AS value, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM loans) AS share
        FROM loans GROUP BY {c} HAVING count(*)::DOUBLE / (SELECT count(*) FROM loans) > 0.0202
        """
        for c in FREQUENT
    ),
)
def _(df):
    """Values that more than 2.02 % of all loans share; loan amounts have none, incomes also NULL if it is frequent."""
    return C.frequent_items(df, FREQUENT, 0.0202)


QUANTILE_COLUMNS = ("loan_amnt", "int_rate", "annual_inc")
PROBABILITIES = (0.1, 0.25, 0.5, 0.75, 0.9)


@query(
    "exact_by_sketch",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", {p}::DOUBLE AS probability, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value,
               count({c}) AS n, 0 AS rank_bound
        FROM loans
        """
        for c in QUANTILE_COLUMNS
        for p in PROBABILITIES
    ),
)
def _(df):
    """With no error allowed the sketch keeps every value, and its quantiles are the exact ones."""
    return C.sketched_quantiles(df, QUANTILE_COLUMNS, PROBABILITIES, error=0.0)


@query(
    "columns_kept_for_training",
    "SELECT unnest(["
    + ", ".join(
        f"'{c}'"
        for c in (
            "loan_amnt", "funded_amnt", "installment", "int_rate", "annual_inc", "dti", "total_acc",
            *V.TWO_VALUED_CATEGORIES, *V.MANY_VALUED_CATEGORIES, "ClassLable", "emp_lengthIndex", "split_point",
        )
    )
    + "]) AS name, (SELECT count(*) FROM loans WHERE annual_inc IS NOT NULL"
    " AND (tot_cur_bal IS NOT NULL OR loan_status IN ('Fully Paid', 'Charged Off'))) AS n",
)
def _(df):
    """Columns that only the exploration needs stay until the model table is made, and then go."""
    explored = P.prepare(df.drop("half_missing", "raw_amount"))
    if not set(V.ANALYSIS_COLUMNS) <= set(explored.columns):
        raise AssertionError("the explored table lacks a column of the analysis")
    table = model_table(explored)
    counts = [F.struct(F.lit(c).alias("name"), F.count(c).alias("n")) for c in table.columns]
    return table.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
