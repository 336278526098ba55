import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbook.operators import quantiles as Q


def nearly(a, b):
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    data = {
        "hot": [round(rng.gauss(0, 1000), 1) for _ in range(5000)],
        "ties": [3.0] * 900 + [4.0] * 100,
        "wild": [1e-300, -1e300, 1e300, 0.0, -0.5, 0.5, 2.0],
        "one": [7.0],
        "two": [1.0, 2.0],
        None: [5.0, 6.0, 9.0],
    }
    return data


@pytest.fixture(scope="module")
def table(spark, groups):
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rows += [("hot", None), ("hot", math.nan), ("empty", None)]
    return spark.createDataFrame(rows, "k string, v double").repartition(7)


@pytest.mark.parametrize("method, numpy_method", [("linear", "linear"), ("lower", "inverted_cdf")])
def test_exact_quantiles_equal_numpy(table, groups, method, numpy_method):
    points = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    names = [f"p{i}" for i in range(len(points))]
    found = {r["k"]: r for r in Q.quantiles(table, "v", points, names, ["k"], method).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        assert found[key]["n"] == len(values)
        expected = np.quantile(values, points, method=numpy_method)
        assert all(nearly(found[key][n], e) for n, e in zip(names, expected)), key


def test_global_quantiles(table, groups):
    everything = [v for vs in groups.values() for v in vs]
    row = Q.five_numbers(table, "v").first()
    expected = np.quantile(everything, Q.FIVE)
    assert row["n"] == len(everything)
    assert all(nearly(row[n], e) for n, e in zip(Q.FIVE_NAMES, expected))


@pytest.fixture(scope="module")
def crowded(spark):
    """Epoch microseconds of a day beside small values: one slice holds nearly all rows of a group."""
    rng = random.Random(11)
    start = 1.7e15
    data = {
        "micros": [start + rng.randrange(86_400_000_000) for _ in range(20_000)],
        "nested": [start + rng.choice([0.0, 1e-1 * rng.randrange(900), float(rng.randrange(10**7))]) for _ in range(20_000)],
        "one_value": [start] * 5000,
        "plain": [float(rng.randrange(100)) for _ in range(500)],
    }
    rows = [(k, v) for k, vs in data.items() for v in vs]
    return data, spark.createDataFrame(rows, "k string, v double").repartition(9).cache()


def test_crowded_values_give_the_same_quantiles(crowded):
    data, table = crowded
    points = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    names = [f"p{i}" for i in range(len(points))]
    for most in (1, 50, Q.ORDERED_ROWS):
        found = {r["k"]: r for r in Q.quantiles(table, "v", points, names, ["k"], most=most).collect()}
        for key, values in data.items():
            assert found[key]["n"] == len(values)
            expected = np.quantile(values, points)
            assert all(nearly(found[key][n], e) for n, e in zip(names, expected)), (key, most)


def test_no_part_that_is_ordered_exceeds_the_bound(crowded):
    data, table = crowded
    rows = Q.measurements(table, "v", ["k"])
    counts = Q.slice_counts(rows, ["k"])
    assert max(r["held"] for r in counts.where("k = 'micros'").collect()) > 5000
    cut = rows.withColumn("slice", Q.slice_of(F.col("value")))
    parts = Q._wanted_parts(cut, counts, ["k"], Q.QUARTILES, "linear", 40).collect()
    assert all(r["held"] <= 40 or r["lowest"] == r["highest"] for r in parts)
    assert len(parts) <= 6 * len(data)


def test_crowded_boxes(crowded):
    data, table = crowded
    found = {r["k"]: r for r in Q.box_stats(table, "v", ["k"], reach=0.5, most=100).collect()}
    for key, values in data.items():
        values = np.array(values)
        q1, q3 = np.quantile(values, (0.25, 0.75))
        inside = values[(values >= q1 - 0.5 * (q3 - q1)) & (values <= q3 + 0.5 * (q3 - q1))]
        row = found[key]
        assert (row["whisker_low"], row["whisker_high"]) == (inside.min(), inside.max())
        assert row["outliers"] == len(values) - len(inside)


def test_box_whiskers_and_outliers(table, groups):
    for row in Q.box_stats(table, "v", ["k"]).collect():
        values = np.array(groups[row["k"]])
        q1, q3 = np.quantile(values, (0.25, 0.75))
        inside = values[(values >= q1 - 1.5 * (q3 - q1)) & (values <= q3 + 1.5 * (q3 - q1))]
        assert row["whisker_low"] == inside.min() and row["whisker_high"] == inside.max()
        assert row["outliers"] == len(values) - len(inside)


def test_slices_never_decrease(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(5000)]
    values += [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, math.nextafter(1.0, 2)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", Q.slice_of(F.col("v")).alias("s")).orderBy("v").collect()
    slices = [r["s"] for r in rows]
    assert slices == sorted(slices)


def test_sketch_stays_within_its_rank_error(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_000).cast("double").alias("v"))
    row = Q.quantiles(df, "v", (0.5,), ("m",), method="approx", accuracy=1000).first()
    assert abs(row["m"] - 50_000) <= 100


def test_unknown_method(table):
    with pytest.raises(ValueError):
        Q.quantiles(table, "v", method="upper")


def test_raw_rows_are_joined_by_broadcast_not_shuffled(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = Q.five_numbers(df, "l_extendedprice", ["l_returnflag"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in text


def test_a_table_without_values_gives_no_rows(spark):
    empty = spark.createDataFrame([("a", None)], "k string, v double")
    assert Q.five_numbers(empty, "v", ["k"]).count() == 0
    assert Q.box_stats(empty, "v", ["k"]).count() == 0
    assert Q.box_stats(empty, "v").count() == 0


def test_one_value_in_most_rows_and_many_keys(spark):
    """A third of all rows share one key and one value; the other keys are many."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20_000).alias("k"),
        F.when(F.col("id") % 3 == 0, 10_000.0).otherwise(F.col("id").cast("double")).alias("v"),
    )
    found = Q.quantiles(df, "v", (0.5,), ("m",), ["k"])
    expected = df.groupBy("k").agg(F.percentile("v", 0.5).alias("e"), F.count("v").alias("c"))
    wrong = found.join(expected, "k", "full").where(
        ~(F.col("m").eqNullSafe(F.col("e")) & F.col("n").eqNullSafe(F.col("c")))
    )
    assert wrong.count() == 0
