import csv

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.operators import aggregates as A
from riskbook.operators import cleaning as C
from riskbook.sources import tables as T


def raw_row(**changes):
    row = {c: "1" for c in V.RAW_COLUMNS}
    row |= {c: None for c in V.MOSTLY_MISSING}
    row |= {"loan_status": "Current", "issue_d": "12/01/2011", "grade": "A", "sub_grade": "A1",
            "term": " 36 months", "emp_length": "2 years", "purpose": "car", "addr_state": "NY"}
    return row | changes


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        raw_row(id="1", tot_cur_bal=None, loan_status=V.FULLY_PAID, total_rev_hi_lim="1234.5"),
        raw_row(id="2", tot_coll_amt=None, loan_status=V.CHARGED_OFF, total_rev_hi_lim="1000"),
        raw_row(id="3", tot_cur_bal=None, loan_status="Current"),
        raw_row(id="4", total_rev_hi_lim=None, loan_status=V.IN_GRACE),
        raw_row(id="5", loan_status=V.LATE_SHORT, annual_inc=None),
        raw_row(id="6", loan_status=None),
        raw_row(id="7", loan_status=V.DEFAULT, loan_amnt="12.5"),
    ]
    schema = T.text_schema(V.RAW_COLUMNS)
    return spark.createDataFrame([tuple(r[c] for c in V.RAW_COLUMNS) for r in rows], schema)


def test_clean_keeps_complete_rows_and_feature_columns_only(raw):
    cleaned = C.clean(raw, keep=["id"])
    rows = {r["id"]: r for r in cleaned.collect()}
    assert {i: r["isDefault"] for i, r in rows.items()} == {"1": 0, "2": 1, "4": 0, "7": 1}
    assert rows["7"]["loan_amnt"] == 12.5
    kept = {*V.NUMERIC_FEATURES, *V.TWO_VALUED_CATEGORIES, *V.MANY_VALUED_CATEGORIES,
            V.ORDINAL_CATEGORY, "isDefault", "id"}
    assert set(cleaned.columns) == kept


def test_measured_missing_columns_equal_the_known_list(raw):
    assert set(C.mostly_missing(raw)) == set(V.MOSTLY_MISSING)


def test_exactly_half_missing_stays(spark):
    df = spark.createDataFrame(
        [(1.0, None, float("nan")), (2.0, None, float("nan")), (None, None, 1.0), (None, "x", None)],
        "half double, more string, nan double",
    )
    profile = {r["column"]: (r["rows"], r["nulls"]) for r in C.null_profile(df).collect()}
    assert profile == {"half": (4, 2), "more": (4, 3), "nan": (4, 3)}
    assert set(C.mostly_missing(df)) == {"more", "nan"}
    assert C.drop_missing(df).columns == ["half"]


def test_profile_of_no_rows(spark):
    df = spark.createDataFrame([], "a string")
    row = C.null_profile(df).first()
    assert (row["rows"], row["nulls"], row["null_ratio"]) == (0, 0, None)


def test_conditional_fill(raw):
    rows = {r["id"]: r for r in C.fill_settled_balances(raw).collect()}
    assert rows["1"]["tot_cur_bal"] == 0.0 and rows["2"]["tot_coll_amt"] == 0.0
    assert rows["3"]["tot_cur_bal"] is None and rows["4"]["tot_cur_bal"] == 1.0


def test_mean_fill_is_cut_to_whole_units_and_survives_decimals(spark):
    df = spark.createDataFrame([("1234.5",), ("1000",), (None,), ("x",)], "total_rev_hi_lim string")
    assert sorted(r[0] for r in C.fill_mean(df).collect()) == [1000.0, 1117.0, 1117.0, 1234.5]
    whole = C.fill_mean(df, truncate=False, scale=2)
    assert sorted(r[0] for r in whole.collect()) == [1000.0, 1117.25, 1117.25, 1234.5]


def test_dropna_takes_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (2.0, None)], "v double, s string")
    assert C.drop_incomplete(df).count() == 1


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_malformed_lines_do_not_depend_on_the_query(spark, tmp_path):
    path = write(tmp_path / "l.csv", ["id,a,b", "1,x,y", "2,x", "3,x,y,z", "4,,", "5"])
    df = T.read_loans_csv(spark, path, ["id", "a", "b"])
    assert df.count() == 2
    assert [r[0] for r in df.select("id").orderBy("id").collect()] == ["1", "4"]
    assert len(df.collect()) == 2
    assert T.read_loans_csv(spark, path).count() == 2


def test_quoted_line_breaks_need_multiline(spark, tmp_path):
    path = write(tmp_path / "m.csv", ["id,desc", '1,"two', 'lines"', "2,one"])
    assert T.read_loans_csv(spark, path, ["id", "desc"], multiline=True).count() == 2


def test_inferred_types(spark, tmp_path):
    path = write(tmp_path / "i.csv", ["id,v", "1,2.5", "2,"])
    assert [t for _, t in T.read_loans_csv(spark, path, infer=True).dtypes] == ["int", "double"]


def test_written_csv_feeds_the_whole_cleaning(spark, tmp_path, raw):
    path = tmp_path / "loan.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(V.RAW_COLUMNS)
        writer.writerows([[v if v is not None else "" for v in r] for r in raw.collect()])
    back = T.read_loans_csv(spark, str(path))
    assert C.clean(back).count() == C.clean(raw).count() == 4


def test_schema_report_and_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, None)], "n int, s string")
    report = [tuple(r) for r in T.schema_report(df).orderBy("position").collect()]
    assert report == [(1, "n", "int", 2), (2, "s", "string", 1)]
    assert [r["n"] for r in T.preview(df, ["n"], 1).collect()] == [1]


def test_fixed_order_shows_empty_categories(spark):
    df = spark.createDataFrame([("b", 2, 1.0), ("z", 9, 1.0)], "k string, n long, m double")
    shown = [tuple(r) for r in A.in_fixed_order(df, "k", ["a", "b"], ["n"]).collect()]
    assert shown == [(0, "a", 0, None), (1, "b", 2, 1.0)]


def test_describe_breaks_ties_by_value_and_skips_null(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,), ("c",)], "s string")
    assert tuple(A.describe_text(df, "s").first()) == (5, 3, "a", 2)


def test_counts_keep_null_keys_and_order_by_size(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "s string")
    rows = [tuple(r) for r in A.count_per(df, "s", largest_first=True).collect()]
    assert rows == [(None, 2), ("a", 1)]
    assert [r["n"] for r in A.count_per(df.where(F.col("s") == "a"), "s").collect()] == [1]


def test_frequent_items_are_exact_and_sketch_keeps_its_bound(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(600, 7), np.full(450, 9), rng.integers(1000, 10**6, 8950)]).tolist()
    rows = [(v, None if i % 4 == 0 else ("-" if i % 4 == 1 else f"t{i}")) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "v int, t string").repartition(6)
    found = {(r["column"], r["value"]): r["n"] for r in C.frequent_items(df, ["v", "t"], 0.04).collect()}
    assert found == {("v", "7"): 600, ("v", "9"): 450, ("t", None): 2500, ("t", "-"): 2500}
    assert C.frequent_items(df.limit(0), ["v"], 0.1).count() == 0
    ordered = np.sort(values)
    for row in C.sketched_quantiles(df, ["v"], [0.1, 0.5, 0.9], error=0.01).collect():
        low, high = np.searchsorted(ordered, row["value"], "left"), np.searchsorted(ordered, row["value"], "right")
        wanted = row["probability"] * row["n"]
        assert row["rank_bound"] == 100 and low - row["rank_bound"] <= wanted <= high + row["rank_bound"]


@pytest.mark.parametrize("most, error", [(40, 0.02), (500, 0.001), (10**6, 0.001)])
def test_quantiles_without_error_need_few_values_at_once(spark, monkeypatch, most, error):
    """Exact among ties and gaps, with only as many values kept by a sketch as it is told."""
    from pyspark.sql import DataFrameStatFunctions

    rng = np.random.default_rng(2)
    values = np.concatenate([np.full(900, 5.0), np.full(700, 6.0), rng.normal(0, 3, 3000), rng.integers(-9, 9, 400)])
    rows = [(float(v), int(v) if i % 3 else None, None) for i, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (float("nan"), None, None)], "v double, w int, none double").repartition(7)
    wanted, exact, own = [0.0, 0.003, 0.1, 0.5, 0.77, 0.9, 1.0], [], DataFrameStatFunctions.approxQuantile

    def watched(self, columns, spots, allowed):
        if allowed == 0:
            exact.extend(self.df.agg(*[F.count(c) for c in columns]).first())
        return own(self, columns, spots, allowed)

    plain = df.stat.approxQuantile(["v", "w", "none"], wanted, 0.0)
    monkeypatch.setattr(DataFrameStatFunctions, "approxQuantile", watched)
    assert C.bracketed_quantiles(df, ["v", "w", "none"], wanted, error, most) == plain
    assert max(exact, default=0) <= most and plain[2] == []
    monkeypatch.setattr(C, "BRACKET_ROWS", most)
    found = C.sketched_quantiles(df, ["v"], wanted, error=0.0).orderBy("probability").collect()
    assert [r["value"] for r in found] == plain[0] and {r["rank_bound"] for r in found} == {0}
