"""A loan-shaped projection of the ``lineitem`` table.

The expressions are plain SQL that Spark and other engines read alike, so the same text feeds the
queries and their SQL twins. Only the columns a query uses are read from the file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOAN_COLUMNS = {
    "id": "concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20)), '-',"
    " cast(l_partkey as varchar(20)), '-', cast(l_suppkey as varchar(20)), '-',"
    " cast(cast(l_shipdate as date) as varchar(20)))",
    "loan_amnt": "l_extendedprice",
    "funded_amnt": "l_extendedprice * (1 - l_discount)",
    "installment": "l_extendedprice / 36",
    "int_rate": "round(5 + 100 * l_discount + 200 * l_tax, 2)",
    "annual_inc": "case when l_partkey % 89 = 0 then null else l_quantity * 20000 - 20000 end",
    "dti": "l_tax * 300 + l_linenumber",
    "total_acc": "l_partkey % 60 + 1",
    "term": "case l_linestatus when 'O' then '36 months' else '60 months' end",
    "initial_list_status": "case l_linestatus when 'O' then 'f' else 'w' end",
    "application_type": "case when l_partkey % 50 = 0 then 'JOINT' else 'INDIVIDUAL' end",
    "pymnt_plan": "case when l_suppkey % 40 = 0 then 'y' else 'n' end",
    "grade": "substr('ABCDEFG', l_linenumber, 1)",
    "sub_grade": "concat(substr('ABCDEFG', l_linenumber, 1),"
    " cast(l_suppkey % 5 + 1 as varchar(2)))",
    "home_ownership": "case l_partkey % 4 when 0 then 'RENT' when 1 then 'MORTGAGE'"
    " when 2 then 'OWN' else 'OTHER' end",
    "verification_status": "case l_returnflag when 'A' then 'Verified' when 'N' then 'Not Verified'"
    " else 'Source Verified' end",
    "purpose": "case l_partkey % 14 when 0 then 'car' when 1 then 'credit_card'"
    " when 2 then 'debt_consolidation' when 3 then 'educational' when 4 then 'home_improvement'"
    " when 5 then 'house' when 6 then 'major_purchase' when 7 then 'medical' when 8 then 'moving'"
    " when 9 then 'other' when 10 then 'renewable_energy' when 11 then 'small_business'"
    " when 12 then 'vacation' else 'wedding' end",
    "addr_state": "concat('S', cast(l_suppkey % 50 as varchar(2)))",
    "emp_length": "case when l_partkey % 12 = 11 then 'n/a' when l_partkey % 12 = 0 then '< 1 year'"
    " when l_partkey % 12 = 1 then '1 year' when l_partkey % 12 = 10 then '10+ years'"
    " else concat(cast(l_partkey % 12 as varchar(2)), ' years') end",
    "loan_status": "case when l_orderkey % 20 < 9 then 'Current'"
    " when l_orderkey % 20 < 14 then 'Fully Paid' when l_orderkey % 20 = 14 then 'Charged Off'"
    " when l_orderkey % 20 = 15 then 'Late (31-120 days)'"
    " when l_orderkey % 20 = 16 then 'In Grace Period'"
    " when l_orderkey % 20 = 17 then 'Late (16-30 days)' when l_orderkey % 20 = 18 then 'Default'"
    " else 'Does not meet the credit policy. Status:Charged Off' end",
    "issue_d": "cast(l_shipdate as date)",
    "tot_cur_bal": "case when l_orderkey % 13 = 0 then null else l_extendedprice * 3 end",
    "tot_coll_amt": "case when l_orderkey % 13 = 0 then null else l_quantity * 10 end",
    "total_rev_hi_lim": "case when l_orderkey % 17 = 0 then null else l_quantity * 1000 end",
    "mths_since_last_delinq": "case when l_partkey % 5 < 3 then null else l_quantity end",
    "half_missing": "case when l_orderkey % 5 < 2 then null else l_quantity end",
    "raw_amount": "case when l_partkey % 97 = 0 then 'n/a'"
    " else cast(l_quantity as varchar(20)) end",
}

LOANS_SQL = (
    "SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in LOAN_COLUMNS.items())
    + " FROM lineitem"
)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.selectExpr(*[f"{sql} AS {name}" for name, sql in LOAN_COLUMNS.items()])
