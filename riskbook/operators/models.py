"""Default-prediction models, their pipelines and what can be read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.operators import features as X

MODELS = ("logistic", "bayes", "forest", "boosted", "svm")


def logistic(features: str = "features", weight: str | None = X.WEIGHT, **options) -> Estimator:
    return _weighted(LogisticRegression(labelCol="label", featuresCol=features, maxIter=3), weight, options)


def bayes(features: str = "features", weight: str | None = X.WEIGHT, **options) -> Estimator:
    """Multinomial; features must not be negative."""
    return _weighted(NaiveBayes(labelCol="label", featuresCol=features, smoothing=50.0), weight, options)


def forest(features: str = "features", **options) -> Estimator:
    model = RandomForestClassifier(
        labelCol="label",
        featuresCol=features,
        impurity="gini",
        maxDepth=12,
        numTrees=10,
        featureSubsetStrategy="auto",
        seed=V.SPLIT_SEED,
    )
    return _weighted(model, None, options)


def boosted(features: str = "features", step: float = 0.1, **options) -> Estimator:
    """A step near zero (1e-8, say) leaves every tree after the first without effect."""
    model = GBTClassifier(
        labelCol="label",
        featuresCol=features,
        maxDepth=5,
        maxBins=5,
        lossType="logistic",
        maxIter=10,
        stepSize=step,
        seed=V.SPLIT_SEED,
    )
    return _weighted(model, None, options)


def svm(features: str = "features", weight: str | None = None, **options) -> Estimator:
    return _weighted(
        LinearSVC(labelCol="label", featuresCol=features, maxIter=50, regParam=0.1), weight, options
    )


def _weighted(model, weight: str | None, options: dict) -> Estimator:
    if weight:
        model = model.setWeightCol(weight)
    return model.copy({model.getParam(name): value for name, value in options.items()})


def estimator(name: str, **options) -> Estimator:
    factories = {
        "logistic": logistic,
        "bayes": bayes,
        "forest": forest,
        "boosted": boosted,
        "svm": svm,
    }
    return factories[name](**options)


# --- pipelines -----------------------------------------------------------------------------------


def encoding_stages(
    columns: Sequence[str], label: str = X.LABEL, include_weight: bool = False
) -> list[Estimator | Transformer]:
    """Index, one-hot, assemble and label stages for the loan columns that are present.

    As pipeline stages they are fitted on training rows only, fold by fold under cross-validation.
    """
    two = [c for c in V.TWO_VALUED_CATEGORIES if c in columns]
    many = [c for c in V.MANY_VALUED_CATEGORIES if c in columns]
    inputs = [c for c in V.NUMERIC_FEATURES if c in columns]
    inputs += [X.index_column(c) for c in two]
    inputs += [X.EMPLOYMENT_INDEX] if X.EMPLOYMENT_INDEX in columns else []
    inputs += [X.vector_column(c) for c in many]
    inputs += [X.WEIGHT] if include_weight else []
    stages: list[Estimator | Transformer] = []
    if two or many:
        stages.append(X.string_indexer([*two, *many]))
    if many:
        stages.append(X.one_hot_encoder(many))
    return [*stages, X.assembler(inputs), X.label_indexer(label)]


def encoding_pipeline(df: DataFrame, **options) -> Pipeline:
    return Pipeline(stages=encoding_stages(df.columns, **options))


def model_pipeline(df: DataFrame, model: Estimator, **options) -> Pipeline:
    return Pipeline(stages=[*encoding_stages(df.columns, **options), model])


def score(model: Transformer, df: DataFrame) -> DataFrame:
    return model.transform(df)


# --- reading a fitted model -----------------------------------------------------------------------


def rules_text(model) -> str:
    """The decision rules of a fitted tree model."""
    return (model.stages[-1] if isinstance(model, PipelineModel) else model).toDebugString


def importances(model, scored: DataFrame, features: str = "features") -> DataFrame:
    """Feature name and importance of a fitted tree model: one short row per slot."""
    tree = model.stages[-1] if isinstance(model, PipelineModel) else model
    names = X.feature_names(scored, features)
    rows = [(n, float(v)) for n, v in zip(names, tree.featureImportances.toArray())]
    return scored.sparkSession.createDataFrame(rows, "feature string, importance double")


def bayes_parameters(
    df: DataFrame, columns: Sequence[str], label: str, weight: str, smoothing: float = 50.0
) -> DataFrame:
    """Multinomial parameters per class and feature as plain sums, in one pass over the rows."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.sum(F.col(weight) * F.col(c)).alias("mass"))
            for c in columns
        ]
    )
    per_class = df.groupBy(label).agg(F.sum(weight).alias("w"), entries.alias("entries"))
    everything = Window.partitionBy(F.lit(0))
    masses = F.transform("entries", lambda e: e["mass"])
    total = F.aggregate(masses, F.lit(0.0), lambda acc, x: acc + x)
    return (
        per_class.withColumn("classes", F.count(F.lit(1)).over(everything))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("total", total)
        .select("*", F.inline("entries"))
        .select(
            label,
            "feature",
            (
                F.log(F.col("w") + smoothing)
                - F.log(F.col("all_w") + smoothing * F.col("classes"))
            ).alias("pi"),
            (
                F.log(F.col("mass") + smoothing)
                - F.log(F.col("total") + smoothing * len(list(columns)))
            ).alias("theta"),
        )
    )
