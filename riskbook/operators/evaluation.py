"""Confusion counts, ratios, ROC points and model comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.operators.lookup import attach, materialised
from riskbook.operators.quantiles import ORDERED_ROWS, slice_of, sub_slice

RATIOS = (
    "ratio_wrong",
    "ratio_correct",
    "accuracy",
    "precision",
    "recall",
    "f1",
    "sensitivity",
    "specificity",
)


def confusion_counts(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    keys: Sequence[str] = (),
) -> DataFrame:
    """All seven counts in one pass. Label 0, the repaid loans, is the positive class.

    ``falseN`` counts label 1 predicted 0 and ``falseP`` label 0 predicted 1. The usual names are
    the other way round; ``ratios`` gives both readings.
    """
    right = F.col(label) == F.col(prediction)
    good, bad = F.col(label) == 0, F.col(label) == 1
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(right).alias("correct"),
        F.count_if(~right).alias("wrong"),
        F.count_if(good & right).alias("trueP"),
        F.count_if(bad & right).alias("trueN"),
        F.count_if(bad & ~right).alias("falseN"),
        F.count_if(good & ~right).alias("falseP"),
    )


def _share(part: str, *parts: str) -> Column:
    whole = reduce(lambda a, b: a + b, [F.col(p) for p in parts]).cast("double")
    return F.try_divide(F.col(part).cast("double"), whole)


def ratios(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Ratios over the counts. A ratio with nothing below the line is NULL.

    The plain names follow the report's own definitions, in percent except for accuracy. Those
    prefixed ``std_`` are the textbook measures of the positive class, as shares of one. F1 is the
    same in both.
    """
    precision, recall = _share("trueP", "trueP", "falseP"), _share("trueP", "trueP", "falseN")
    named = {
        "ratio_wrong": _share("wrong", "total"),
        "ratio_correct": _share("correct", "total"),
        "accuracy": _share("correct", "total"),
        "precision": 100 * precision,
        "recall": 100 * recall,
        "f1": 100 * F.try_divide(2 * precision * recall, precision + recall),
        "sensitivity": 100 * recall,
        "specificity": 100 * _share("trueN", "trueN", "falseP"),
        # textbook readings, label 0 positive: a missed positive is label 0 predicted 1
        "std_precision": recall,
        "std_recall": precision,
        "std_specificity": _share("trueN", "trueN", "falseN"),
        "std_negative_predictive_value": _share("trueN", "trueN", "falseP"),
    }
    measures = [c for c in counts.columns if c not in keys]
    return counts.select(*keys, *measures, *[v.alias(k) for k, v in named.items()])


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    right = F.count_if(F.col(label) == F.col(prediction))
    return df.agg(F.try_divide(right.cast("double"), F.count(F.lit(1))).alias("accuracy"))


def positive_scores(scored: DataFrame, label: str = "label") -> DataFrame:
    """(score, target) pairs: probability of class 0, and 1 where the label is 0.

    A model without probabilities is scored by its raw margin for class 0. Nothing leaves the
    cluster. Persist the result when it feeds several measures, else each one runs the model again.
    """
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.select(
        vector_to_array(source)[0].alias("score"), (1 - F.col(label)).alias("target")
    )


def _sliced(rows: DataFrame, most: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows with the path of the slice of the score line they lie in, the counts of all those slices, and the path's
    columns. Slices of more than ``most`` rows are cut again between their own ends until they are small or hold one
    score; only the counts of crowded slices meet the rows, never the curve."""
    hits, misses = F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses")
    ends = F.min("threshold").alias("lowest"), F.max("threshold").alias("highest")
    path = ["slice"]
    cut = rows.withColumn("slice", slice_of(F.col("threshold")))
    now = materialised(cut.groupBy(*path).agg(hits, misses, *ends), "scores")
    crowded = (F.col("hits") + F.col("misses") > most) & (F.col("lowest") < F.col("highest"))
    settled: list[DataFrame] = []
    while True:
        settled.append(now.where(~crowded))
        open_ = now.where(crowded)
        if open_.isEmpty():
            break
        step = f"slice{len(path)}"
        inner = sub_slice(F.col("threshold"), F.col("lowest"), F.col("highest"))
        here = F.when(F.col("lowest").isNotNull(), inner).alias(step)  # NULL where the slice is settled
        cut = attach(cut, open_, path, ("lowest", "highest"), "left").select(*rows.columns, *path, here)
        now = materialised(
            cut.where(F.col(step).isNotNull()).groupBy(*path, step).agg(hits, misses, *ends), "scores"
        )
        path = [*path, step]
    slices = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), settled)
    return cut, slices, path


def roc_points(
    df: DataFrame,
    score: str = "score",
    target: str = "target",
    bins: int | None = None,
    most: int = ORDERED_ROWS,
) -> DataFrame:
    """Threshold, false-positive and true-positive rate at every distinct score, best first.

    The running counts are not taken in one ordered pass over all scores. Counts per slice of the
    score line give what lies above each slice; the order is then worked out inside each slice, of which none
    has more than ``most`` rows unless they share one score. With
    ``bins`` scores are cut down to multiples of 1/bins first, and :func:`thinned` picks a curve of bounded size
    from the exact counts.
    """
    value = F.col(score).cast("double")
    if bins:
        value = F.floor(value * bins) / bins
    rows = df.select(value.alias("threshold"), (F.col(target) == 1).alias("hit")).where(
        F.col("threshold").isNotNull() & F.col("hit").isNotNull()
    )
    cut, slices, path = _sliced(rows, most)
    hits, misses = F.count_if("hit"), F.count_if(~F.col("hit"))

    def above(window, count: str):
        upto = F.sum(count).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return upto - F.col(count)

    # First what lies above each first slice, one row for each, then above the finer ones within it.
    firsts = slices.groupBy("slice").agg(F.sum("hits").alias("h"), F.sum("misses").alias("m"))
    down, everything = Window.partitionBy(F.lit(0)).orderBy(F.desc("slice")), Window.partitionBy(F.lit(0))
    firsts = firsts.select(
        "slice",
        above(down, "h").alias("base_hits"),
        above(down, "m").alias("base_misses"),
        F.sum("h").over(everything).alias("all_hits"),
        F.sum("m").over(everything).alias("all_misses"),
    )
    finer = Window.partitionBy("slice").orderBy(F.desc("lowest"))
    totals = ("all_hits", "all_misses")
    based = attach(slices, firsts, ["slice"], ("base_hits", "base_misses", *totals))
    placed_slices = materialised(
        based.select(
            *path,
            (F.col("base_hits") + above(finer, "hits")).alias("hits_above"),
            (F.col("base_misses") + above(finer, "misses")).alias("misses_above"),
            *totals,
        ),
        "scores",
    )
    within = (
        Window.partitionBy(*path)
        .orderBy(F.desc("threshold"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    tied = cut.groupBy(*path, "threshold").agg(hits.alias("hits"), misses.alias("misses"))
    placed = attach(tied, placed_slices, path, ("hits_above", "misses_above", *totals)).select(
        "threshold",
        "hits",
        "misses",
        (F.col("hits_above") + F.sum("hits").over(within)).alias("tp"),
        (F.col("misses_above") + F.sum("misses").over(within)).alias("fp"),
        "all_hits",
        "all_misses",
    )
    return placed.select(
        "threshold",
        "hits",
        "misses",
        "tp",
        "fp",
        "all_hits",
        "all_misses",
        F.try_divide(F.col("fp").cast("double"), F.col("all_misses")).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.col("all_hits")).alias("tpr"),
    )


def thinned(points: DataFrame, steps: int = 1000) -> DataFrame:
    """A curve of at most ``steps`` of the points, for drawing: those at which the rows so far pass a whole step, of equal
    numbers of rows. Each point is kept or not by its own counts; the last one always stays."""
    upto, own = F.col("tp") + F.col("fp"), F.col("hits") + F.col("misses")
    total = F.col("all_hits") + F.col("all_misses")

    def passed(rows):
        return F.floor(rows * F.lit(steps) / total)

    return points.where(passed(upto) > passed(upto - own))


def roc_area(points: DataFrame) -> DataFrame:
    """Trapezoid area under the ROC points; NULL when one of the classes is absent.

    Each point carries its own step, so the sum needs neither an order nor a neighbour, and it is
    taken in whole numbers so that the area cannot vary between runs.
    """
    step = F.col("misses").cast("decimal(19,0)") * (2 * F.col("tp") - F.col("hits"))
    whole = 2 * F.max("all_hits").cast("double") * F.max("all_misses").cast("double")
    return points.agg(F.try_divide(F.sum(step).cast("double"), whole).alias("area"))


def evaluator_area(
    scored: DataFrame, label: str = "label", raw: str = "rawPrediction", bins: int = 1000
) -> float:
    """The library's own area under ROC; ``bins=0`` is exact, the default curve is down-sampled."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, numBins=bins
    ).evaluate(scored)


def evaluator_accuracy(scored: DataFrame, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(scored)


def compare(scored: Mapping[str, DataFrame], label: str = "label", bins: int | None = None):
    """One row per model: counts, ratios and area under ROC, exact unless ``bins`` cuts the scores down."""
    rows = []
    for name, df in scored.items():
        area = roc_area(roc_points(positive_scores(df, label), bins=bins))
        rows.append(
            ratios(confusion_counts(df, label)).select(
                F.lit(name).alias("model"), "*", area.scalar().alias("area_under_roc")
            )
        )
    return reduce(DataFrame.unionByName, rows)
