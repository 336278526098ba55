import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbook.operators import distributions as D
from riskbook.operators import intervals as I


@pytest.fixture(scope="module")
def sample():
    return np.random.default_rng(11).gamma(3.0, 40.0, 4000)


@pytest.fixture(scope="module")
def table(spark, sample):
    rows = [("a" if i % 3 else "b", float(v), i) for i, v in enumerate(sample)]
    return spark.createDataFrame(rows, "k string, v double, i int")


def test_histogram_equals_numpy(table, sample):
    rows = D.histogram(table, "v", 17).orderBy("bin").collect()
    counts, edges = np.histogram(sample, bins=17)
    assert [r["count"] for r in rows] == list(counts)
    assert np.allclose([r["low"] for r in rows], edges[:-1])
    width = edges[1] - edges[0]
    assert math.isclose(sum(r["density"] for r in rows) * width, 1.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 9, "v double")
    rows = D.histogram(df, "v").orderBy("bin").collect()
    assert len(rows) == 3 and sum(r["count"] for r in rows) == 9
    assert rows[0]["low"] == 4.5 and rows[-1]["high"] == 5.5


def test_density_integrates_to_one_and_follows_the_kernel_sum(table, sample):
    rows = D.kernel_density(table, "v", points=200, cut=5).orderBy("point").collect()
    x = np.array([r["x"] for r in rows])
    density = np.array([r["density"] for r in rows])
    assert math.isclose(np.trapezoid(density, x), 1.0, rel_tol=1e-3)
    h = sample.std(ddof=1) * len(sample) ** -0.2
    exact = np.exp(-0.5 * ((x[:, None] - sample) / h) ** 2).sum(1)
    exact /= len(sample) * h * math.sqrt(2 * math.pi)
    assert np.abs(density - exact).max() < 0.01 * exact.max()


def test_density_per_group_uses_the_groups_own_spread(table, sample):
    rows = D.kernel_density(table, "v", ["k"], points=100, cut=5).collect()
    for key in "ab":
        curve = sorted((r["x"], r["density"]) for r in rows if r["k"] == key)
        x, d = map(np.array, zip(*curve))
        assert math.isclose(np.trapezoid(d, x), 1.0, rel_tol=1e-3)


def test_groups_without_spread_have_no_density(spark):
    df = spark.createDataFrame([("c", 2.0)] * 5 + [("s", 1.0)], "k string, v double")
    assert D.kernel_density(df, "v", ["k"]).count() == 0


def test_gamma_fit_recovers_parameters_and_is_a_maximum(table, sample):
    row = D.gamma_fit(table, "v").first()
    assert abs(row["shape"] - 3.0) < 0.2 and abs(row["scale"] - 40.0) < 3.0
    assert math.isclose(row["shape"] * row["scale"], sample.mean(), rel_tol=1e-12)

    def likelihood(shape, scale):
        return ((shape - 1) * np.log(sample) - sample / scale).sum() - len(sample) * (
            shape * math.log(scale) + math.lgamma(shape)
        )

    best = likelihood(row["shape"], row["scale"])
    assert math.isclose(row["log_likelihood"], best, rel_tol=1e-9)
    assert best >= likelihood(row["shape"] * 1.001, row["scale"])
    assert best >= likelihood(row["shape"] * 0.999, row["scale"])


def test_gamma_fit_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(2.0,)] * 4, "v double")
    assert D.gamma_fit(df, "v").first()["shape"] is None


def test_density_beside_outliers(spark, sample):
    wild = np.append(sample, [-9e4, 2e5])
    df = spark.createDataFrame([(float(v),) for v in wild], "v double")
    rows = D.kernel_density(df, "v", points=400).collect()
    h = wild.std(ddof=1) * len(wild) ** -0.2
    x = np.array([r["x"] for r in rows])
    exact = np.exp(-0.5 * ((x[:, None] - wild) / h) ** 2).sum(1) / (len(wild) * h * math.sqrt(2 * math.pi))
    assert np.abs(np.array([r["density"] for r in rows]) - exact).max() < 0.01 * exact.max()


@pytest.mark.parametrize("statistic", ["mean", "sum"])
def test_bootstrap_agrees_with_the_closed_form(table, sample, statistic):
    closed = {r["k"]: r for r in I.normal_interval(table, ["k"], "v", statistic, scale=None).collect()}
    drawn = I.bootstrap_interval(table, ["k"], "v", ["i"], statistic, replicates=400, scale=None)
    for row in drawn.collect():
        width = closed[row["k"]]["high"] - closed[row["k"]]["low"]
        assert abs((row["high"] - row["low"]) / width - 1) < 0.35
        assert row["low"] < closed[row["k"]]["estimate"] < row["high"]


def test_bootstrap_does_not_depend_on_partitioning(table):
    a = I.bootstrap_interval(table.repartition(1), ["k"], "v", ["i"], "sum", scale=2)
    b = I.bootstrap_interval(table.repartition(9), ["k"], "v", ["i"], "sum", scale=2)
    assert sorted(a.collect()) == sorted(b.collect())


def test_poisson_weights_have_mean_and_variance_one(spark):
    draws = spark.range(20_000).select(
        I.poisson_weight((F.col("id") + 0.5) / F.lit(20_000.0)).alias("w")
    )
    row = draws.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v")).first()
    assert abs(row["m"] - 1) < 1e-3 and abs(row["v"] - 1) < 2e-3


def test_tables_without_values(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert D.histogram(empty, "v").count() == 0
    assert D.histogram(empty, "v", 5).count() == 0
    assert D.kernel_density(empty, "v").count() == 0
    assert D.gamma_fit(empty, "v").first()["shape"] is None


def test_gamma_location_is_found_and_near_the_maximum(spark):
    rng = np.random.default_rng(4)
    groups = {"far": 1000 + rng.gamma(3.0, 40.0, 4000), "near": rng.gamma(2.0, 5.0, 4000), None: -50 + rng.gamma(4.0, 1.0, 3000)}
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("flat", 2.0), ("flat", 2.0), ("far", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    found = {r["k"]: r for r in D.gamma_fit_location(df, "v", ["k"]).collect()}
    assert set(found) == set(groups)
    for key, location, scale in (("far", 1000, 40.0), ("near", 0, 5.0), (None, -50, 1.0)):
        values, row = groups[key], found[key]
        assert abs(row["location"] - location) < 0.6 * scale and row["n"] == len(values)

        def likelihood(at, shape, width):
            x = values - at
            return float(np.sum((shape - 1) * np.log(x) - x / width) - len(x) * (shape * math.log(width) + math.lgamma(shape)))

        assert math.isclose(row["log_likelihood"], likelihood(row["location"], row["shape"], row["scale"]), rel_tol=1e-4)
        plain = D.gamma_fit(df.where(F.col("k").eqNullSafe(key)), "v", location=float(values.min()) - 0.001).first()
        assert row["log_likelihood"] > plain["log_likelihood"] - 0.5


def test_rows_at_or_below_the_location_are_counted(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (5.0,), (None,)], "v double")
    row = D.gamma_fit(df, "v", location=2.0).first()
    assert (row["n"], row["below"]) == (2, 2)
