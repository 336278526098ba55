"""From a raw loan table to scored default models.

    table = stored(model_table(loans, key=["id"]))
    train, test = split(X.add_weight(table))
    report = compare_models(fit_models(train), test)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import employment_years
from riskbook.operators import cleaning, evaluation, models
from riskbook.operators import features as X
from riskbook.operators.lookup import in_parts, materialised
from riskbook.sources.session import file_by_file, remove_at_exit, shared_folder, wide_rows

SPLIT_POINT = "split_point"
# Of the stored model table: small parts to fill the cores while there are few, then parts of a file's size.
SMALL_PART_ROWS, PART_ROWS, SMALL_PARTS = 25_000, 1_000_000, 64
# Of one file, and about those that one task takes in training: the tree learners keep some 600 bytes a row, read up to
# three times at once, and every task of a forest sends sums for all open nodes.
FILE_ROWS, TASK_ROWS = 200_000, 250_000


def parts_for(rows: int) -> int:
    """Partitions of a model table, from nothing but its number of rows."""
    return max(1, min(-(-rows // SMALL_PART_ROWS), SMALL_PARTS), -(-rows // PART_ROWS))


def model_table(
    df: DataFrame,
    key: Sequence[str] = ("id",),
    missing_columns: Sequence[str] | None = V.MOSTLY_MISSING,
    seed: int = V.SPLIT_SEED,
) -> DataFrame:
    """Cleaned rows with label and ordinal code, categories still as text.

    The row's split point is taken from its key, which then goes. Categories stay text until
    the encoders of a model pipeline, so that those are fitted on training rows only.
    """
    cleaned = cleaning.clean(df, missing_columns, keep=key)
    labelled = cleaned.withColumns(
        {X.EMPLOYMENT_INDEX: employment_years(), SPLIT_POINT: X.split_point(key, seed)}
    ).drop(V.ORDINAL_CATEGORY, *[k for k in key if k not in V.NUMERIC_FEATURES])
    return labelled.withColumnRenamed("isDefault", X.LABEL).drop(*V.ANALYSIS_COLUMNS)


def stored(table: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write the model table to the shared folder and go on from the written copy.

    Training reads the table many times. From the copy each pass is a plain columnar scan, without
    cleaning the raw rows and averaging the fills over again, and a lost executor costs a re-read.
    The rows are dealt to ``partitions`` files by their split point and sorted in each, so the copy does
    not depend on how the table arrived; by default their number follows from the counted rows. It is
    removed when the session ends.
    The class weight is best added to the copy, where measuring the classes reads one column.
    """
    spark = table.sparkSession
    with wide_rows(spark):
        path = remove_at_exit(spark, f"{shared_folder(spark)}/riskbook-model-{uuid4().hex}")
        dealt = table.repartition(partitions or parts_for(table.count()), SPLIT_POINT).sortWithinPartitions(SPLIT_POINT)
        dealt.write.option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        return spark.read.schema(dealt.schema).parquet(path)


def encoded(encoder: PipelineModel, rows: DataFrame, columns: Sequence[str], level: StorageLevel) -> DataFrame:
    """The encoded rows, kept in parts of some ``TASK_ROWS``."""
    vectors = encoder.transform(in_parts(rows, TASK_ROWS)).select(*columns).persist(level)
    with file_by_file(rows.sparkSession):
        vectors.count()
    return vectors


def split(table: DataFrame, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by split point."""
    at = F.col(SPLIT_POINT)
    return (
        table.where(at < F.lit(share)).drop(SPLIT_POINT),
        table.where(at >= F.lit(share)).drop(SPLIT_POINT),
    )


def fit_models(
    train: DataFrame, estimators: Mapping[str, Estimator] | None = None, **encoding
) -> dict[str, PipelineModel]:
    """Fit several models on one encoding of the training rows.

    Encoders are fitted once and the vectors kept on disk while the models make their passes: every learner
    keeps its own form of them in memory, which two copies would crowd. Lost blocks are recomputed from the rows.
    """
    estimators = estimators or {name: models.estimator(name) for name in models.MODELS}
    encoder = models.encoding_pipeline(train, **encoding).fit(train)
    vectors = encoded(encoder, train, ["label", "features", X.WEIGHT], StorageLevel.DISK_ONLY)
    try:
        return {
            name: PipelineModel(stages=[*encoder.stages, model.fit(vectors)])
            for name, model in estimators.items()
        }
    finally:
        vectors.unpersist()


def fit_on_components(
    train: DataFrame, estimator: Estimator, k: int = 3, **encoding
) -> PipelineModel:
    """Fit a model on ``k`` standardised principal components of the encoded features."""
    encoder = models.encoding_pipeline(train, **encoding).fit(train)
    vectors = encoded(encoder, train, ["label", "features", X.WEIGHT], StorageLevel.DISK_ONLY)
    try:
        reduced = X.pca_model(vectors, k, standardise=True)
        model = estimator.fit(reduced.transform(vectors))
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*encoder.stages, *reduced.stages, model])


def compare_models(fitted: Mapping[str, PipelineModel], test: DataFrame, bins: int | None = None):
    """Score the test rows with every model and put their measures side by side.

    Rows are encoded once for models that share their encoders, as those of ``fit_models`` do, and the vectors kept on disk.
    The counts and the curve both read the scores, so each scored set is narrowed to what they need
    and persisted until the measures, one row per model, are there.
    """
    vectors, source_rows, scorers = None, test, dict(fitted)
    if len(fitted) > 1 and _share_encoders(list(fitted.values())):
        scorers = {name: model.stages[-1] for name, model in fitted.items()}
        encoder = PipelineModel(stages=next(iter(fitted.values())).stages[:-1])
        kept = sorted({"label", *[model.getFeaturesCol() for model in scorers.values()]})
        source_rows = vectors = encoded(encoder, test, kept, StorageLevel.DISK_ONLY)
    scored = {}
    try:
        for name, model in scorers.items():
            rows = model.transform(source_rows)
            source = "probability" if "probability" in rows.columns else "rawPrediction"
            scored[name] = rows.select("label", "prediction", source).persist(
                StorageLevel.MEMORY_AND_DISK
            )
        return materialised(evaluation.compare(scored, bins=bins))
    finally:
        for rows in scored.values():
            rows.unpersist()
        if vectors is not None:
            vectors.unpersist()


def _share_encoders(fitted: Sequence[PipelineModel]) -> bool:
    """Whether the pipelines differ in their last stage only, a model of one column of vectors."""
    first, *others = [model.stages for model in fitted]
    same = all(len(o) == len(first) and all(a is b for a, b in zip(o[:-1], first[:-1])) for o in others)
    return same and len(first) > 1 and all(hasattr(model.stages[-1], "getFeaturesCol") for model in fitted)


def grade_model(train: DataFrame, estimator: Estimator | None = None) -> PipelineModel:
    """Predict the loan's grade instead of its default: more than two classes.

    ``sub_grade`` would give the grade away and is left out.
    """
    estimator = estimator or models.logistic(weight=None, maxIter=10, family="multinomial")
    rows = train.drop(X.LABEL, X.WEIGHT, "sub_grade").withColumnRenamed("grade", "grade_label")
    encoder = models.encoding_pipeline(rows, label="grade_label").fit(rows)
    vectors = encoded(encoder, rows, ["label", "features"], StorageLevel.DISK_ONLY)
    try:
        return PipelineModel(stages=[*encoder.stages, estimator.fit(vectors)])
    finally:
        vectors.unpersist()
