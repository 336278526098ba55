import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskbook.operators import evaluation as M


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    target = rng.integers(0, 2, 3000)
    score = np.round(np.clip(rng.normal(0.4 + 0.2 * target, 0.2), 0, 1), 2)  # many ties
    rows = [(float(s), int(t), float(1 - t), float(s < 0.5)) for s, t in zip(score, target)]
    return spark.createDataFrame(rows, "score double, target int, label double, prediction double")


def by_hand(df):
    pairs = [(r["score"], r["target"]) for r in df.collect()]
    hits = np.array([s for s, t in pairs if t == 1])
    misses = np.array([s for s, t in pairs if t == 0])
    wins = (hits[:, None] > misses).sum() + 0.5 * (hits[:, None] == misses).sum()
    return wins / (len(hits) * len(misses))


def test_area_equals_pair_counting_and_the_evaluator(scored):
    area = M.roc_area(M.roc_points(scored)).first()["area"]
    assert math.isclose(area, by_hand(scored), rel_tol=1e-12)
    typed = scored.withColumn("target", F.col("target").cast("double"))
    assert math.isclose(area, M.evaluator_area(typed, "target", "score", bins=0), rel_tol=1e-9)


def test_points_climb_to_one(scored):
    points = M.roc_points(scored).orderBy(F.desc("threshold")).collect()
    assert len(points) == scored.select("score").distinct().count()
    for before, after in zip(points, points[1:]):
        assert after["tp"] >= before["tp"] and after["fp"] >= before["fp"]
    assert points[-1]["tpr"] == points[-1]["fpr"] == 1.0


def test_binned_points_are_bounded_and_close(scored):
    points = M.roc_points(scored, bins=20)
    assert points.count() <= 21
    assert abs(M.roc_area(points).first()["area"] - by_hand(scored)) < 0.01


@pytest.fixture(scope="module")
def crowded(spark):
    """Scores within 0.0004 of each other, of which most lie in one slice of the line."""
    rng = np.random.default_rng(3)
    target = rng.integers(0, 2, 4000)
    score = 0.75 + rng.integers(0, 3000, 4000) * 1e-7 + target * 2e-5
    score[:500] = 0.75 + rng.integers(0, 40, 500) * 1e-12
    score[500:600] = rng.random(100)
    rows = [(float(s), int(t)) for s, t in zip(score, target)]
    return spark.createDataFrame(rows, "score double, target int").repartition(6).cache()


@pytest.mark.parametrize("most", [1, 30, M.ORDERED_ROWS])
def test_crowded_scores_give_the_same_points(crowded, most):
    points = M.roc_points(crowded, most=most)
    assert math.isclose(M.roc_area(points).first()["area"], by_hand(crowded), rel_tol=1e-12)
    rows = points.collect()
    pairs = [(r["score"], r["target"]) for r in crowded.collect()]
    scores = np.array([s for s, _ in pairs])
    hit = np.array([t for _, t in pairs])
    assert len(rows) == len(set(scores))
    for r in rows[::17]:
        upto = scores >= r["threshold"]
        assert (r["tp"], r["fp"]) == (hit[upto].sum(), (1 - hit[upto]).sum())


def test_no_slice_of_scores_exceeds_the_bound(crowded):
    rows = crowded.select(F.col("score").alias("threshold"), (F.col("target") == 1).alias("hit"))
    cut, slices, path = M._sliced(rows, 30)
    assert all(
        r["hits"] + r["misses"] <= 30 or r["lowest"] == r["highest"] for r in slices.collect()
    )
    assert cut.count() == 4000 and max(r["count"] for r in cut.groupBy(*path).count().collect()) <= 30
    assert max(r["count"] for r in cut.groupBy("slice").count().collect()) > 1000


def test_thinned_curve(crowded):
    points = M.roc_points(crowded)
    thin = M.thinned(points, 50).collect()
    assert 40 <= len(thin) <= 50 and max(r["tpr"] + r["fpr"] for r in thin) == 2.0
    upto = sorted(r["tp"] + r["fp"] for r in thin)
    own = max(r["hits"] + r["misses"] for r in points.collect())
    assert max(b - a for a, b in zip(upto, upto[1:])) <= 4000 / 50 + own


def test_area_of_a_single_class_is_null(scored):
    for target in (0, 1):
        one = scored.where(F.col("target") == target)
        assert M.roc_area(M.roc_points(one)).first()["area"] is None


def test_scores_without_a_value_are_left_out(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (None, 1)], "score double, target int")
    assert M.roc_area(M.roc_points(df)).first()["area"] == 1.0


def test_confusion_names_and_both_readings(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 3 + [(1.0, 0.0)] * 2 + [(1.0, 1.0)] * 7
    counts = M.confusion_counts(spark.createDataFrame(rows, "label double, prediction double"))
    row = M.ratios(counts).first()
    assert (row["trueP"], row["trueN"], row["falseN"], row["falseP"]) == (5, 7, 2, 3)
    assert (row["total"], row["correct"], row["wrong"]) == (17, 12, 5)
    assert math.isclose(row["precision"], 500 / 8) and math.isclose(row["recall"], 500 / 7)
    assert math.isclose(row["specificity"], 70) and math.isclose(row["accuracy"], 12 / 17)
    assert math.isclose(row["std_precision"], 5 / 7) and math.isclose(row["std_recall"], 5 / 8)
    assert math.isclose(row["std_specificity"], 7 / 9)
    p, r = row["std_precision"], row["std_recall"]
    assert math.isclose(row["f1"], 200 * p * r / (p + r))


def test_ratios_with_nothing_below_the_line_are_null(spark):
    empty = spark.createDataFrame([], "label double, prediction double")
    row = M.ratios(M.confusion_counts(empty)).first()
    assert row["total"] == 0 and all(row[c] is None for c in M.RATIOS)
    wrong = spark.createDataFrame([(1.0, 0.0)], "label double, prediction double")
    row = M.ratios(M.confusion_counts(wrong)).first()
    assert row["precision"] is None and row["recall"] == 0 and row["f1"] is None


def test_scores_come_from_the_first_class(spark):
    rows = [(Vectors.dense(0.8, 0.2), 0.0), (Vectors.dense(0.3, 0.7), 1.0)]
    df = spark.createDataFrame(rows, ["probability", "label"])
    assert [tuple(r) for r in M.positive_scores(df).collect()] == [(0.8, 1.0), (0.3, 0.0)]


def test_library_evaluator_agrees_on_accuracy(scored):
    assert M.evaluator_accuracy(scored) == M.accuracy(scored).first()["accuracy"]
