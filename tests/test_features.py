import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskbook.operators import features as X


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [
        (i, "abc"[i % 3], float(x), float(2 * x + e), int(x + e > 0))
        for i, (x, e) in enumerate(rng.normal(size=(600, 2)))
    ]
    return spark.createDataFrame(data, "id int, grade string, x double, y double, ClassLable int")


def test_one_hot_names_survive_hazards():
    names = X.one_hot_names("c", ["a.b c", "A.B C", "tick`", "id"], taken=["c_id"])
    assert list(names.values()) == ["c_a_b c", "c_A_B C_2", "c_tick_", "c_id_2"]


def test_one_hot_columns_of_awkward_values(spark):
    df = spark.createDataFrame([("grade",), ("Grade",), ("x.y",), (None,)], "grade string")
    wide = X.one_hot_columns(df, ["grade"])
    assert wide.columns == ["grade", "grade_Grade", "grade_grade_2", "grade_x_y"]
    sums = wide.agg(*[F.sum(F.col(c)) for c in wide.columns[1:]]).first()
    assert tuple(sums) == (1, 1, 1)


def test_too_many_values_are_refused_not_cut(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("k"))
    with pytest.raises(ValueError):
        X.category_values(df, ["k"], most=10)


def test_unseen_values_become_zeros(spark, rows):
    model = X.string_indexer(["grade"]).fit(rows)
    hot = X.one_hot_encoder(["grade"]).fit(model.transform(rows))
    new = spark.createDataFrame([("a",), ("new",), (None,)], "grade string")
    vectors = [r[0] for r in hot.transform(model.transform(new)).select("gradeVec").collect()]
    assert [v.size for v in vectors] == [3, 3, 3]
    assert [sum(v.toArray()) for v in vectors] == [1.0, 0.0, 0.0]


def test_sparse_vectors_equal_the_wide_columns(rows):
    wide = X.one_hot_columns(rows, ["grade"])
    expected = {f"gradeVec_{g}": wide.agg(F.sum(f"grade_{g}")).first()[0] for g in "abc"}
    indexed = X.string_indexer(["grade"]).fit(rows).transform(rows)
    hot = X.one_hot_encoder(["grade"]).fit(indexed).transform(indexed)
    packed = X.assembler(["gradeVec"]).transform(hot)
    sums = X.vector_sums(packed, X.feature_names(packed)).collect()
    assert {r["feature"]: r["total"] for r in sums} == expected


def test_weight_is_measured_or_given_and_kept_from_the_features(rows):
    share = rows.agg(F.avg("ClassLable")).first()[0]
    weights = dict(X.add_weight(rows).select("ClassLable", X.WEIGHT).distinct().collect())
    assert math.isclose(weights[0], share) and math.isclose(weights[1], 1 - share)
    given = X.add_weight(rows, ratio=0.0735)
    assert dict(given.select("ClassLable", X.WEIGHT).distinct().collect()) == {0: 0.0735, 1: 0.9265}
    assert X.feature_columns(given) == ["id", "grade", "x", "y"]
    assert X.feature_columns(given, include_weight=True)[-1] == X.WEIGHT


def test_weight_reads_the_table_once(rows):
    plan = X.add_weight(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") <= 2  # named once, described once


def test_hash_split_ignores_partitioning(rows):
    parts = []
    for n in (1, 2, 8):
        train, test = X.hash_split(rows.repartition(n), ["id"])
        parts.append(sorted(r["id"] for r in train.collect()))
        assert train.count() + test.count() == 600
    assert parts[0] == parts[1] == parts[2] and 380 < len(parts[0]) < 460


def test_random_split_covers_everything(rows):
    train, test = X.random_split(rows)
    assert train.count() + test.count() == 600


def test_label_index_has_no_third_class(rows):
    indexed = X.label_indexer().fit(rows).transform(rows)
    assert len(indexed.schema["label"].metadata["ml_attr"]["vals"]) == 2


def test_components_are_orthonormal_and_ordered(rows):
    packed = X.assembler(["x", "y"]).transform(rows)
    model = X.pca_model(packed, 2)
    matrix = model.stages[-1].pc.toArray()
    assert np.allclose(matrix.T @ matrix, np.eye(2))
    spread = model.stages[-1].explainedVariance.toArray()
    assert spread[0] >= spread[1] and math.isclose(spread.sum(), 1.0)
    values = packed.select(vector_to_array("features").alias("f")).first()["f"]
    projected = model.transform(packed).select(vector_to_array("pcaFeatures").alias("p")).first()
    assert np.allclose(projected["p"], np.array(values) @ matrix)  # not centred


def test_anova_by_hand_and_selection(rows):
    data = rows.select("x", "y", "ClassLable").toPandas()
    scores = {r["feature"]: r["f_value"] for r in X.anova_scores(rows, ["x", "y"], "ClassLable").collect()}
    for name in ("x", "y"):
        groups = [g[name] for _, g in data.groupby("ClassLable")]
        between = sum(len(g) * (g.mean() - data[name].mean()) ** 2 for g in groups)
        inside = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(data) - 2)
        assert math.isclose(scores[name], between / inside, rel_tol=1e-9)
    noisy = rows.withColumn("noise", F.pmod(F.hash("id"), F.lit(97)).cast("double"))
    packed = X.assembler(["noise", "x", "y"]).transform(noisy)
    assert sorted(X.select_by_score(packed, 2, label="ClassLable").selectedFeatures) == [1, 2]
    packed = X.assembler(["x", "y"]).transform(rows)
    kept = X.select_by_variance(packed, 1.5).selectedFeatures
    variances = {r["feature"]: r["variance"] for r in X.feature_variances(rows, ["x", "y"]).collect()}
    assert [["x", "y"][i] for i in kept] == [f for f in ("x", "y") if variances[f] > 1.5]


def test_labelled_points(rows):
    packed = X.label_indexer().fit(rows).transform(X.assembler(["x", "y"]).transform(rows))
    assert X.labelled_points(packed).columns == ["label", "features"]


def test_long_encoding_leaves_the_rows_of_a_common_value_where_they_are(spark):
    """In a shuffle one task would get all of them."""
    rows = [(i, "often" if i % 10 else f"t{i}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "id int, c string").repartition(8)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    try:
        encoded = X.long_encoding(df, ["id"], ["c"])
        held = encoded.where("value = 'often'").groupBy(F.spark_partition_id()).count().collect()
        assert len(held) >= 8 and max(r["count"] for r in held) < 6000
        assert encoded.select("id", "value").exceptAll(df).count() == 0 and encoded.count() == 20_000
        slots = {r["value"]: r["slot"] for r in encoded.select("value", "slot").distinct().collect()}
        assert slots["often"] == 0 and sorted(slots.values()) == list(range(2001))
    finally:
        spark.conf.set(key, before)
