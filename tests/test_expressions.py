import datetime
import math

import pytest
from pyspark.sql import functions as F

from riskbook.functions import expressions as E
from riskbook.functions import vocabulary as V


def values(spark, column, rows, dtype="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_roles_cover_all_named_columns_once():
    assert len(V.RAW_COLUMNS) == len(set(V.RAW_COLUMNS)) == 74
    assert len(V.SUB_GRADE_ORDER) == 35 and len(V.INCOME_ORDER) == 15
    assert V.EMP_LENGTH_ORDER[:3] == ("n/a", "< 1 year", "1 year")
    assert V.EMP_LENGTH_ORDER[-1] == "10+ years" and len(V.EMP_LENGTH_ORDER) == 12


def test_income_bins_at_every_edge_and_outside(spark):
    rows = [None, math.nan, -10001.0, -10000.0, 0.0, 19999.99, 20000.0, 4999999.0, 5000000.0]
    got = values(spark, E.income_range("v"), rows)
    assert got == [
        ">5000000", ">5000000", ">5000000", "0-20000", "0-20000", "0-20000", "20000-40000",
        "1000000-5000000", ">5000000",
    ]
    edges = [float(e) for e in V.INCOME_EDGES[:-1]]
    assert values(spark, E.income_range("v"), edges) == list(V.INCOME_RANGES)


def test_rate_bins_at_every_edge_and_outside(spark):
    rows = [None, 4.99, 5.0, 6.99, 7.0, 29.99, 30.0, math.nan]
    got = values(spark, E.rate_range("v"), rows)
    assert got == [">30%", ">30%", "5-7%", "5-7%", "7-9%", "25-30%", ">30%", ">30%"]


def test_bins_need_matching_labels():
    with pytest.raises(ValueError):
        E.bin_label("v", (0, 1), ("a", "b"), "c")


def test_numbers_and_dates_tolerate_bad_text(spark):
    assert values(spark, E.number("v"), ["x", "", "12.5", None], "string") == [None, None, 12.5, None]
    texts = ["12/01/2011", "Dec-2011", "1/5/2011", "", None]
    day = datetime.date
    assert values(spark, E.day("v"), texts, "string") == [day(2011, 12, 1), None, None, None, None]
    loose = values(spark, E.day("v", "M/d/yyyy"), texts, "string")
    assert loose == [day(2011, 12, 1), None, day(2011, 1, 5), None, None]


def test_quarter_label(spark):
    days = [datetime.date(2015, 4, 1), datetime.date(2015, 12, 31), None]
    assert values(spark, E.quarter_label("v"), days, "date") == ["2015Q2", "2015Q4", None]


def test_employment_years(spark):
    rows = ["n/a", None, "< 1 year", "1 year", "9 years", "10+ years", "11 years"]
    assert values(spark, E.employment_years("v"), rows, "string") == [0, 0, 0, 1, 9, 10, 0]


def test_three_different_default_sets(spark):
    rows = [V.DEFAULT, V.CHARGED_OFF, V.IN_GRACE, V.LATE_LONG, V.LATE_SHORT, V.OFF_POLICY,
            V.FULLY_PAID, "Current", None]
    assert values(spark, E.bad_label("v"), rows, "string") == [1, 1, 0, 1, 1, 1, 0, 0, 0]
    troubled = values(spark, F.coalesce(E.troubled("v"), F.lit(False)), rows, "string")
    assert troubled == [True, False, True, True, True, True, False, False, False]
    only = values(spark, F.coalesce(E.only_default("v"), F.lit(False)), rows, "string")
    assert only == [True] + [False] * 8


def test_casting_twice_changes_nothing(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    once = E.cast_numbers(df, ["a", "b", "no_such_column"])
    assert E.cast_numbers(once, ["a", "b"]).collect() == once.collect()


def test_hash_is_the_known_md5_prefix(spark):
    import hashlib

    expected = int(hashlib.md5(b"k|7").hexdigest()[:8], 16)
    assert values(spark, E.hash32("v", F.lit(7)), ["k"], "string") == [expected]
