"""Cross-validated grids and their result tables.

``cross_validate`` fits every grid point in every fold, with the library's own search. ``tune`` searches the grids of
the five models with fewer fits, which give the same numbers:

- naive Bayes needs class and feature sums only. One pass takes them per fold; the training sums of a fold are the sums
  of all others, so no row is read again to fit.
- A boosted model of 15 steps begins with those of 5 and 10. One run for each depth, step size and fold serves all three, and
  the runs of a depth grow their trees side by side: a pass over the rows serves a level of all of them (``boosting``).
- Logistic models and support vectors of all folds and settings are fitted side by side: a pass over the rows serves every
  one of them, and a run of 10 iterations has passed through the models of 1 and 3 (``lockstep``).
- A linear model that has converged after k iterations is the same for any larger limit. Where few fits are wanted, the
  longest run of each setting is fitted first and stands for the shorter ones that it does not need.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LinearSVC, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.functions.expressions import hash32
from riskbook.operators import boosting, lockstep
from riskbook.operators.features import WEIGHT
from riskbook.operators.lookup import in_parts
from riskbook.operators.models import encoding_pipeline, encoding_stages, estimator
from riskbook.sources.session import file_by_file

# --- Fixed values: the full grids and their measures ---------------------------------------------

GRIDS = {
    "logistic": {
        "regParam": [0.01, 0.1, 1.0],
        "elasticNetParam": [0.0, 0.5, 1.0],
        "maxIter": [1, 3, 10],
    },
    "bayes": {"smoothing": [1.0, 2.0, 3.0]},
    "forest": {
        "maxBins": [25, 28, 31, 34],
        "maxDepth": [4, 6, 8, 12],
        "impurity": ["entropy", "gini"],
    },
    "boosted": {"maxDepth": [3, 5, 10], "maxIter": [5, 10, 15], "stepSize": [0.01, 0.1, 1.0]},
    "svm": {"regParam": [0.01, 0.1, 1.0], "maxIter": [50, 75, 100]},
}
MEASURES = {
    "logistic": "areaUnderROC",
    "bayes": "accuracy",
    "forest": "areaUnderROC",
    "boosted": "accuracy",
    "svm": "areaUnderROC",
}
FOLDS = 10
TASK_ROWS = 250_000  # about those that a task takes
FEW_RUNS = 8  # fits, of folds and settings, that gain little from sharing their passes
AT_ONCE = 4  # scores of a fold measured at a time: each is a few short jobs


def grid_size(grid: Mapping[str, Sequence]) -> int:
    return len(list(product(*grid.values())))


def evaluator(measure: str):
    if measure == "areaUnderROC":
        return BinaryClassificationEvaluator(labelCol="label", metricName=measure)
    return MulticlassClassificationEvaluator(labelCol="label", metricName=measure)


def with_folds(df: DataFrame, key: Sequence[str], folds: int, seed: int = 1395) -> DataFrame:
    """Fold number per row from the row's key, the same after any retry or repartitioning."""
    return df.withColumn("fold", F.pmod(hash32(*key, F.lit(seed)), F.lit(folds)).cast("int"))


@dataclass
class Search:
    """A finished grid search: the ranked table, the scoring pipeline and the fitted search."""

    table: DataFrame
    model: PipelineModel
    fitted: CrossValidatorModel


def cross_validate(
    train: DataFrame,
    model: Estimator,
    grid: Mapping[str, Sequence],
    measure: str = "areaUnderROC",
    folds: int = FOLDS,
    key: Sequence[str] | None = None,
    parallelism: int = 4,
    seed: int = 1395,
    refit_encoders: bool = False,
    **encoding,
) -> Search:
    """Search a grid by cross-validation; ``parallelism`` grid points are fitted at a time.

    The encoders do not depend on the grid, so by default they are fitted once on the training rows
    and the search reads the persisted vectors: 270 fits then mean 270 fits of the model alone. With
    ``refit_encoders`` they are stages of the searched pipeline and fitted anew in every fold. With
    ``key`` the folds are fixed by hash.
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    points = builder.build()
    if key:
        train = with_folds(train, key, folds, seed)

    encoder = None
    rows, stages = train, [*encoding_stages(train.columns, **encoding), model]
    if not refit_encoders:
        encoder = encoding_pipeline(train, **encoding).fit(train)
        kept = ["label", "features", *[c for c in ("fold", WEIGHT) if c in train.columns]]
        rows = encoder.transform(train).select(*kept).persist(StorageLevel.MEMORY_AND_DISK)
        stages = [model]
    search = CrossValidator(
        estimator=Pipeline(stages=stages),
        estimatorParamMaps=points,
        evaluator=evaluator(measure),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
    )
    if key:
        search = search.setFoldCol("fold")
    try:
        fitted = search.fit(rows)
    finally:
        if encoder is not None:
            rows.unpersist()
    best = fitted.bestModel
    if encoder is not None:
        best = PipelineModel(stages=[*encoder.stages, *best.stages])
    return Search(_table(train.sparkSession, points, fitted, measure), best, fitted)


# --- searches with fewer fits ------------------------------------------------------------------------


@dataclass
class Split:
    """Rows with features, label and fold, and the parts of them that a fold trains on and holds out."""

    rows: DataFrame
    folds: int

    def train(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("fold") != fold)

    def held_out(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("fold") == fold)


def at_once(rows: DataFrame) -> int:
    """Fits to run at a time: as many as fill the cores, since a fit of few partitions leaves most of them idle."""
    partitions = max(1, rows.rdd.getNumPartitions())
    return max(2, -(-rows.sparkSession.sparkContext.defaultParallelism // partitions))


def _in_threads(jobs: Iterable, run, threads: int) -> list:
    session = SparkSession.active()
    with ThreadPool(threads) as pool:
        return pool.map(inheritable_thread_target(session)(run), list(jobs), chunksize=1)


def _by_settings(points: Sequence[dict], without: str) -> list[list[int]]:
    """Numbers of the grid points that differ in one parameter only, the largest of it first."""
    groups: dict[tuple, list[int]] = {}
    for i, point in enumerate(points):
        rest = tuple(sorted((p.name, v) for p, v in point.items() if p.name != without))
        groups.setdefault(rest, []).append(i)
    value = [{p.name: v for p, v in point.items()}.get(without) for point in points]
    return [sorted(g, key=lambda i: -value[i]) for g in groups.values()]


def bayes_metrics(split: Split, model: NaiveBayes, points: Sequence[dict], threads: int) -> np.ndarray:
    """Accuracy per fold and grid point from one pass of sums and one of scores."""
    weight = F.col(model.getWeightCol()) if model.isSet("weightCol") else F.lit(1.0)
    means = Summarizer.mean(F.col("features"), weight).alias("mean")
    # A row for each fold and class, whatever the number of rows.
    found = split.rows.groupBy("fold", "label").agg(means, F.sum(weight).alias("weight")).collect()
    labels = sorted({r["label"] for r in found})
    spark = split.rows.sparkSession

    def training_sums(fold: int) -> DataFrame:
        rows = []
        for label in labels:
            others = [r for r in found if r["label"] == label and r["fold"] != fold]
            total = sum(r["weight"] for r in others)
            sums = sum((r["weight"] * r["mean"].toArray() for r in others), 0.0)
            if total:
                rows.append((label, float(total), [float(v) for v in sums / total]))
        frame = spark.createDataFrame(rows, "label double, weight double, mean array<double>")
        return frame.select("label", "weight", array_to_vector("mean").alias("features"))

    def fit(job: tuple[int, int]) -> Model:
        """The library's model of a few rows: a class's mean features, weighted by the class's weight."""
        fold, point = job
        fitted = model.copy({**points[point], model.weightCol: "weight"}).fit(tables[fold])
        # Without the vectors of scores, which nothing here reads, a row is scored in one step.
        return fitted.setRawPredictionCol("").setProbabilityCol("")

    tables = [training_sums(fold) for fold in range(split.folds)]
    jobs = [(fold, point) for fold in range(split.folds) for point in range(len(points))]
    scored = [
        fitted.transform(split.held_out(fold)).select(
            F.lit(fold).alias("fold"), F.lit(point).alias("point"), (F.col("prediction") == F.col("label")).alias("right")
        )
        for (fold, point), fitted in zip(jobs, _in_threads(jobs, fit, threads))
    ]
    counted = reduce(DataFrame.union, scored).groupBy("fold", "point").agg(F.avg(F.col("right").cast("int")).alias("a"))
    metrics = np.zeros((split.folds, len(points)))
    for row in counted.collect():
        metrics[row["fold"], row["point"]] = row["a"]
    return metrics


def staged_predictions(model: GBTClassificationModel, rows: DataFrame, steps: Sequence[int]) -> DataFrame:
    """The rows with one column ``at_k`` for each number of steps: the class that the model's first k trees give."""
    columns = rows.columns
    for number, tree in enumerate(model.trees[: max(steps)]):
        rows = tree.setFeaturesCol("features").setPredictionCol(f"tree_{number}").transform(rows)
    stages = {}
    for k in steps:
        margin = sum((F.lit(w) * F.col(f"tree_{i}") for i, w in enumerate(model.treeWeights[:k])), F.lit(0.0))
        stages[f"at_{k}"] = F.when(margin > 0, 1.0).otherwise(0.0)
    return rows.select(*columns, *[c.alias(name) for name, c in stages.items()])


def boosted_metrics(split: Split, model: Estimator, points: Sequence[dict], threads: int) -> np.ndarray:
    """Accuracy per fold and grid point; the points that differ in their number of steps share their trees. The trees of all
    folds and step sizes are grown side by side; where there are few, each fold and setting is fitted by the library."""
    groups = _by_settings(points, "maxIter")
    grown = {model.maxDepth, model.maxIter, model.stepSize}
    if len(groups) * split.folds > FEW_RUNS and grown.issuperset(points[0]) and boosting.supported(model, split.rows):
        wanted = [tuple(p.get(q, model.getOrDefault(q)) for q in (model.maxDepth, model.stepSize, model.maxIter)) for p in points]
        found = boosting.searched(split.rows, model, split.folds, [w[:2] for w in wanted], [w[2] for w in wanted])
        return np.column_stack([found[w] for w in wanted])
    metrics = np.zeros((split.folds, len(points)))

    def run(job: tuple[int, list[int]]) -> None:
        fold, group = job
        steps = [points[i][model.maxIter] for i in group]
        fitted = model.copy(points[group[0]]).fit(split.train(fold))
        staged = staged_predictions(fitted, split.held_out(fold), steps)
        shares = [F.avg((F.col(f"at_{k}") == F.col("label")).cast("int")) for k in steps]
        metrics[fold, group] = list(staged.agg(*shares).first())

    # The deepest trees take longest; they go first, so that no thread waits for them in the end.
    groups.sort(key=lambda g: -points[g[0]][model.maxDepth])
    _in_threads([(fold, g) for g in groups for fold in range(split.folds)], run, threads)
    return metrics


def linear_metrics(
    split: Split, model: Estimator, points: Sequence[dict], threads: int, measure: str = "areaUnderROC"
) -> np.ndarray:
    """The measure per fold and grid point of models fitted by iteration; a run that stops by itself also stands for
    the shorter ones it did not need."""
    metrics = np.zeros((split.folds, len(points)))

    def run(job: tuple[int, list[int]]) -> None:
        fold, group = job
        taken, value = None, 0.0
        for i in group:
            most = points[i][model.maxIter]
            if taken is None or taken > most:
                fitted = model.copy(points[i]).fit(split.train(fold))
                summary = fitted.summary() if callable(fitted.summary) else fitted.summary  # a method or a property, by model
                taken = summary.totalIterations
                value = evaluator(measure).evaluate(fitted.transform(split.held_out(fold)))
            metrics[fold, i] = value

    groups = _by_settings(points, "maxIter")
    _in_threads([(fold, g) for fold in range(split.folds) for g in groups], run, threads)
    return metrics


def shared_metrics(
    split: Split, model: Estimator, points: Sequence[dict], threads: int, measure: str = "areaUnderROC"
) -> np.ndarray:
    """The measure per fold and grid point of linear models that share every pass over the rows."""
    groups = _by_settings(points, "maxIter")
    hinge = isinstance(model, LinearSVC)
    penalties = [model.regParam] if hinge else [model.regParam, model.elasticNetParam]
    if len(groups) * split.folds <= FEW_RUNS or not {*penalties, model.maxIter}.issuperset(points[0]):
        return linear_metrics(split, model, points, threads, measure)
    settings = [{p.name: points[g[0]].get(p, model.getOrDefault(p)) for p in penalties} for g in groups]
    weight = F.col(model.getWeightCol()) if model.isSet("weightCol") else F.lit(1.0)
    packed = lockstep.blocks(split.rows, weight).persist(StorageLevel.DISK_ONLY)
    scored = None
    try:
        size = len(split.rows.select("features").first()[0])
        known = lockstep.moments(packed, split.folds, size)
        if not known.two_labels():
            return linear_metrics(split, model, points, threads, measure)
        most = max(points[g[0]][model.maxIter] for g in groups)
        runs = lockstep.fit_side_by_side(packed, known, settings, most, model.getTol(), hinge)
        # Which run, and which of the points it passed, each grid point stands for.
        places = {i: (n, points[i][model.maxIter]) for n, g in enumerate(groups) for i in g}
        reached = [{i: (n, min(k, len(own[n].points) - 1)) for i, (n, k) in places.items()} for own in runs]
        columns = [sorted(set(found.values())) for found in reached]
        models = [
            np.column_stack([own[n].plain(own[n].points[k]) for n, k in used]) for own, used in zip(runs, columns)
        ]
        scored = lockstep.scores(packed, size, models).persist(StorageLevel.DISK_ONLY)

        def measured(job: tuple[int, int]) -> float:
            fold, column = job
            rows = scored.where(F.col("fold") == fold).select("label", F.col("margins")[column].alias("rawPrediction"))
            return evaluator(measure).evaluate(rows)

        jobs = [(fold, column) for fold, used in enumerate(columns) for column in range(len(used))]
        values = dict(zip(jobs, _in_threads(jobs, measured, max(threads, AT_ONCE))))
        return np.array(
            [[values[fold, used.index(found[i])] for i in range(len(points))] for fold, (found, used) in enumerate(zip(reached, columns))]
        )
    finally:
        packed.unpersist()
        if scored is not None:
            scored.unpersist()


def single_metrics(
    split: Split, model: Estimator, points: Sequence[dict], threads: int, measure: str = "areaUnderROC"
) -> np.ndarray:
    """The measure per fold and grid point, one fit for each."""
    metrics = np.zeros((split.folds, len(points)))

    def run(job: tuple[int, int]) -> None:
        fold, i = job
        fitted = model.copy(points[i]).fit(split.train(fold))
        metrics[fold, i] = evaluator(measure).evaluate(fitted.transform(split.held_out(fold)))

    slowest = sorted(range(len(points)), key=lambda i: -max((v for v in points[i].values() if not isinstance(v, str)), default=0))
    _in_threads([(fold, i) for i in slowest for fold in range(split.folds)], run, threads)
    return metrics


def tune(
    name: str,
    train: DataFrame,
    key: Sequence[str],
    folds: int = FOLDS,
    parallelism: int | None = None,
    seed: int = 1395,
    grid: Mapping[str, Sequence] | None = None,
    **encoding,
) -> Search:
    """Search the full grid of one of the five models by its own measure, with folds fixed by the rows' key.

    The rows are encoded once and kept; a fold is a filter over them. ``parallelism`` fits run at a time, by default
    as many as fill the cores.
    """
    model, measure = estimator(name), MEASURES[name]
    builder = ParamGridBuilder()
    for parameter, values in (grid or GRIDS[name]).items():
        builder = builder.addGrid(model.getParam(parameter), list(values))
    points = builder.build()
    train = with_folds(train, key, folds, seed)
    encoder = encoding_pipeline(train, **encoding).fit(train)
    kept = ["label", "features", *[c for c in ("fold", WEIGHT) if c in train.columns]]
    # Learners that draw rows keep them as dealt. The others take parts of bounded rows, kept on disk: a task sorts no more, and
    # memory is left to the passes. With the rows of a fold together, a scan of one reads its blocks only.
    if name != "forest":
        train = in_parts(train, TASK_ROWS)
    ordered = train.sortWithinPartitions("fold") if name in ("bayes", "logistic", "svm") else train
    level = StorageLevel.MEMORY_AND_DISK if name == "forest" else StorageLevel.DISK_ONLY
    rows = encoder.transform(ordered).select(*kept).persist(level)
    try:
        with file_by_file(rows.sparkSession):
            rows.count()
        split, threads = Split(rows, folds), parallelism or at_once(rows)
        if name == "bayes":
            metrics = bayes_metrics(split, model, points, threads)
        elif name == "boosted":
            metrics = boosted_metrics(split, model, points, threads)
        elif name in ("logistic", "svm"):
            metrics = shared_metrics(split, model, points, threads, measure)
        else:
            metrics = single_metrics(split, model, points, threads, measure)
        means, deviations = metrics.mean(axis=0).tolist(), metrics.std(axis=0).tolist()
        best = model.copy(points[int(np.argmax(means))]).fit(rows)
    finally:
        rows.unpersist()
    fitted = CrossValidatorModel(best, means, stdMetrics=deviations)
    pipeline = PipelineModel(stages=[*encoder.stages, best])
    return Search(_table(train.sparkSession, points, fitted, measure), pipeline, fitted)


def _table(spark, points, fitted: CrossValidatorModel, measure: str) -> DataFrame:
    rows = []
    for point, mean, deviation in zip(points, fitted.avgMetrics, fitted.stdMetrics):
        named = sorted((p.name, v) for p, v in point.items())
        rows.append((", ".join(f"{n}={v}" for n, v in named), float(mean), float(deviation)))
    # Means that differ by rounding only are equal, and go by their parameters.
    rows.sort(key=lambda r: (-round(r[1], 12), r[0]))
    return spark.createDataFrame(
        [(i + 1, *row) for i, row in enumerate(rows)],
        f"rank int, parameters string, mean_{measure} double, std_{measure} double",
    )


def best_parameters(fitted: CrossValidatorModel, names: Sequence[str]) -> dict[str, object]:
    """Chosen values of the named parameters; a parameter the model lacks is left out."""
    best = fitted.bestModel
    stage = best.stages[-1] if isinstance(best, PipelineModel) else best
    return {n: stage.getOrDefault(n) for n in names if stage.hasParam(n)}
