"""Files, views and schema reports. The files are written by Spark from the given tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.loans import LOAN_COLUMNS
from riskbook.catalog.registry import query
from riskbook.functions.expressions import day, number
from riskbook.operators.aggregates import money_sum
from riskbook.sources import tables as T
from riskbook.sources.session import remove_at_exit, shared_folder

CSV_COLUMNS = ["id", "loan_amnt", "annual_inc", "grade", "emp_length", "issue_d"]


def fresh_path(df: DataFrame, kind: str) -> str:
    spark = df.sparkSession
    return remove_at_exit(spark, f"{shared_folder(spark)}/riskbook-{kind}-{uuid4().hex}")


def write_csv(df: DataFrame) -> str:
    path = fresh_path(df, "csv")
    df.select(*CSV_COLUMNS).write.option("header", True).csv(path)
    return path


BY_GRADE = """
    SELECT grade, count(*) AS n, CAST(sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS DOUBLE) AS loan_amnt,
           count(annual_inc) AS incomes, CAST(min(issue_d) AS VARCHAR) AS first_issue
    FROM loans GROUP BY 1
"""


@query("csv_roundtrip", BY_GRADE)
def _(df):
    back = T.read_loans_csv(df.sparkSession, write_csv(df), CSV_COLUMNS)
    return back.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum(number("loan_amnt")).alias("loan_amnt"),
        F.count(number("annual_inc")).alias("incomes"),
        F.min(day("issue_d", "yyyy-MM-dd")).cast("string").alias("first_issue"),
    )


@query("csv_inferred", BY_GRADE)
def _(df):
    back = T.read_loans_csv(df.sparkSession, write_csv(df), infer=True)
    return back.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("loan_amnt").alias("loan_amnt"),
        F.count("annual_inc").alias("incomes"),
        F.min("issue_d").cast("string").alias("first_issue"),
    )


@query(
    "csv_malformed_lines",
    """
    SELECT grade, count(*) AS n, CAST(sum(CAST(loan_amnt AS DECIMAL(18, 2))) AS DOUBLE) AS loan_amnt
    FROM loans WHERE raw_amount <> 'n/a' AND pymnt_plan = 'n' GROUP BY 1
    """,
)
def _(df):
    """Lines that are too short or too long are left out, whichever columns the query reads."""
    line = (
        F.when(F.col("raw_amount") == "n/a", F.col("id"))
        .when(F.col("pymnt_plan") == "y", F.concat_ws(",", "id", "loan_amnt", "grade", "grade"))
        .otherwise(F.concat_ws(",", "id", "loan_amnt", "grade"))
    )
    path = fresh_path(df, "lines")
    df.select(line.alias("value")).write.text(path)
    back = T.read_loans_csv(df.sparkSession, path, ["id", "loan_amnt", "grade"], header=False)
    return back.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n"), money_sum(number("loan_amnt")).alias("loan_amnt")
    )


@query(
    "parquet_copy",
    "SELECT addr_state, count(*) AS n, max(int_rate) AS int_rate FROM loans"
    " WHERE grade = 'C' GROUP BY 1",
)
def _(df):
    columns = df.select("id", "grade", "addr_state", "int_rate", "loan_amnt")
    copy = T.write_table(columns, fresh_path(df, "table"), partition_by=["grade"])
    return (
        copy.where(F.col("grade") == "C")
        .groupBy("addr_state")
        .agg(F.count(F.lit(1)).alias("n"), F.max("int_rate").alias("int_rate"))
    )


# --- Fixed values: types of the loan columns that are not text ----------------------------------
TYPES = {
    "total_acc": "bigint",
    "issue_d": "date",
    **dict.fromkeys(
        "loan_amnt funded_amnt installment int_rate annual_inc dti tot_cur_bal tot_coll_amt"
        " total_rev_hi_lim mths_since_last_delinq half_missing".split(),
        "double",
    ),
}


@query(
    "schema_report",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\","
        f" '{TYPES.get(c, 'string')}' AS type, count({c}) AS filled FROM loans"
        for i, c in enumerate(LOAN_COLUMNS, 1)
    ),
)
def _(df):
    return T.schema_report(df)


@query(
    "view_counts",
    "SELECT purpose, term, count(*) AS n, max(loan_amnt) AS largest FROM loans"
    " WHERE grade IN ('A', 'B') GROUP BY 1, 2 ORDER BY 1, 2",
)
def _(df):
    T.register_view(df, "loan_table")
    return df.sparkSession.sql(
        """
        SELECT purpose, term, count(*) AS n, max(loan_amnt) AS largest
        FROM loan_table WHERE grade IN ('A', 'B')
        GROUP BY purpose, term ORDER BY purpose, term
        """
    )
