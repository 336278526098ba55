"""Labels, weights, encodings, feature vectors, splits and feature selection."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import (
    PCA,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VarianceThresholdSelector,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import employment_years, hash32
from riskbook.operators.lookup import materialised, numbered

LABEL = "ClassLable"
WEIGHT = "weightColumn"
EMPLOYMENT_INDEX = "emp_lengthIndex"


# --- label and weight -----------------------------------------------------------------------------


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and share per class. The shares come from a window over the few counted classes."""
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(0))
    share = F.col("n").cast("double") / F.sum("n").over(everything)
    return counted.select(label, "n", share.alias("share"))


def balancing_ratio(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Share of label 1, from whole counts."""
    return df.agg((F.sum(label).cast("double") / F.count(label)).alias("ratio"))


def add_weight(df: DataFrame, label: str = LABEL, ratio: float | None = None) -> DataFrame:
    """Weight r for label 0 and 1 - r for label 1, r being the share of label 1.

    The share is measured by a scalar subquery unless given. A NULL label has no weight. The weight repeats the label, so it
    belongs in a weight column and never among the features.
    """
    r = balancing_ratio(df, label).scalar() if ratio is None else F.lit(float(ratio))
    # |label - r| is r for 0 and 1 - r for 1; naming r once keeps it to one subquery
    return df.withColumn(WEIGHT, F.abs(F.col(label) - r))


# --- categorical encodings -----------------------------------------------------------------------


def index_column(column: str) -> str:
    return f"{column}Index"


def vector_column(column: str) -> str:
    return f"{column}Vec"


def string_indexer(columns: Sequence[str], unseen: str = "keep") -> StringIndexer:
    """One estimator, and one pass, for all columns: most frequent first, ties alphabetical."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[index_column(c) for c in columns],
        handleInvalid=unseen,
        stringOrderType="frequencyDesc",
    )


def label_indexer(label: str = LABEL) -> StringIndexer:
    """Label indexing must not keep unseen values: that would add a third class."""
    return StringIndexer(inputCol=label, outputCol="label", handleInvalid="error")


def index_to_text(df: DataFrame, column: str, labels: Sequence[str], output: str) -> DataFrame:
    return IndexToString(inputCol=column, outputCol=output, labels=list(labels)).transform(df)


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Sparse one-hot vectors over indexed columns.

    The index keeps an extra last code for unseen values; leaving the last code out gives exactly
    one slot per observed value, and an unseen value is all zeros.
    """
    return OneHotEncoder(
        inputCols=[index_column(c) for c in columns],
        outputCols=[vector_column(c) for c in columns],
        dropLast=True,
    )


def category_values(
    df: DataFrame, columns: Sequence[str], most: int = 1000
) -> dict[str, list[str]]:
    """Sorted distinct values of several columns, in one pass.

    They become column names, so more than ``most`` in total is refused rather than cut short;
    ``long_encoding`` takes any number.
    """
    columns = list(columns)
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    found = (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .limit(most + 1)
        .collect()
    )
    if len(found) > most:
        raise ValueError(f"more than {most} values in {columns}: use one_hot_encoder or long_encoding instead")
    values: dict[str, list[str]] = {c: [] for c in columns}
    for row in found:
        values[row["name"]].append(row["value"])
    return {c: sorted(v) for c, v in values.items()}


def one_hot_names(column: str, values: Sequence[str], taken: Sequence[str] = ()) -> dict[str, str]:
    """Column name per value: ``grade_A``. Characters a column path cannot hold become ``_``, and
    names that Spark would take for equal (it ignores case) get a number."""
    used = {t.lower() for t in taken}
    names = {}
    for value in values:
        base = name = f"{column}_{re.sub(r'[.`]', '_', value)}"
        count = 2
        while name.lower() in used:
            name, count = f"{base}_{count}", count + 1
        used.add(name.lower())
        names[value] = name
    return names


def one_hot_columns(
    df: DataFrame,
    columns: Sequence[str],
    values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """A 0/1 column per observed value of each column, all added in one projection."""
    values = values or category_values(df, columns)
    taken, flags = list(df.columns), []
    for column in columns:
        names = one_hot_names(column, values[column], taken)
        taken += names.values()
        flags += [
            F.when(F.col(column) == F.lit(value), 1).otherwise(0).alias(name)
            for value, name in names.items()
        ]
    return df.select("*", *flags)


# --- encodings without a limit on values ----------------------------------------------------------


COMMON = 1000


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of every column with its count and slot: column, value, n, slot.

    Slots are numbered column by column, most frequent value first and ties alphabetical, like those of
    ``string_indexer``; but the dictionary is a table, so it may have any number of values. NULL is no value.
    """
    listed = F.array(
        *[
            F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for i, c in enumerate(columns)
        ]
    )
    counted = (
        df.select(F.inline(listed))
        .where(F.col("value").isNotNull())
        .groupBy("at", "column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return numbered(counted, ["at", F.desc("n"), "value"], "slot").drop("at")


def long_encoding(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], dictionary: DataFrame | None = None
) -> DataFrame:
    """One row for each row and filled slot: the key, column, value, slot, x (1.0).

    A value that the dictionary lacks has no row, as an unseen value is all zeros. The values that hold more than a
    ``COMMON``-th of all entries, fewer than ``COMMON``, are kept as a table of their own, so that Spark broadcasts them: in a
    shuffle a single task would get all rows of one. The others are joined by broadcast or by shuffle, as their number
    allows. A dictionary without counts (``n``) is joined as it is.
    """
    dictionary = category_dictionary(df, columns) if dictionary is None else dictionary
    listed = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    pairs = df.select(*key, F.inline(listed)).where(F.col("value").isNotNull())
    on, slots = ["column", "value"], ["column", "value", "slot"]
    if "n" not in dictionary.columns:
        joined = pairs.join(dictionary.select(*slots), on)
    else:
        total = dictionary.agg(F.sum("n")).scalar()
        often = F.col("n") * COMMON > total
        marked = pairs.join(materialised(dictionary.where(often).select(*slots), "common"), on, "left")
        rest = marked.where(F.col("slot").isNull()).drop("slot")
        rare = rest.join(dictionary.where(~often).select(*slots), on)
        joined = marked.where(F.col("slot").isNotNull()).unionByName(rare)
    return joined.select(*key, "column", "value", "slot", F.lit(1.0).alias("x"))


def vectors_of(encoded: DataFrame, key: Sequence[str], size: int, output: str = "features") -> DataFrame:
    """Sparse vectors of ``size`` slots from the long form, one for each key. A row has as many entries as it has columns;
    the function that packs them is the only step that Spark has no expression for."""
    packed = F.udf(
        lambda entries: Vectors.sparse(size, [e["slot"] for e in entries], [e["x"] for e in entries]), VectorUDT()
    )
    entries = F.array_sort(F.collect_list(F.struct("slot", "x")))
    return encoded.groupBy(*key).agg(entries.alias("entries")).select(*key, packed("entries").alias(output))


# --- model table ----------------------------------------------------------------------------------


def encode_wide(
    df: DataFrame,
    label_source: str = "isDefault",
    weight_ratio: float | None = None,
    unseen: str = "keep",
) -> DataFrame:
    """The wide model table: indexes, one column per category value, ordinal, label and weight."""
    two = [c for c in V.TWO_VALUED_CATEGORIES if c in df.columns]
    many = [c for c in V.MANY_VALUED_CATEGORIES if c in df.columns]
    indexed = string_indexer(two, unseen).fit(df).transform(df)
    wide = one_hot_columns(indexed, many).withColumn(EMPLOYMENT_INDEX, employment_years())
    wide = wide.drop(*two, *many, V.ORDINAL_CATEGORY).withColumnRenamed(label_source, LABEL)
    return add_weight(wide, ratio=weight_ratio).drop(*V.ANALYSIS_COLUMNS)


def feature_columns(df: DataFrame, include_weight: bool = False) -> list[str]:
    """All columns but the label. The weight repeats the label and stays out unless asked for."""
    left_out = {LABEL} if include_weight else {LABEL, WEIGHT}
    return [c for c in df.columns if c not in left_out]


def assembler(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")


def labelled_points(df: DataFrame, label: str = "label") -> DataFrame:
    return df.select(F.col(label).cast("double").alias("label"), "features")


# --- principal components ------------------------------------------------------------------------


def pca_model(df: DataFrame, k: int = 3, features: str = "features", standardise: bool = False):
    """Fitted stages for ``k`` components in ``pcaFeatures``.

    Without scaling, the column with the largest units takes nearly all the variance.
    """
    from pyspark.ml import Pipeline

    source, stages = features, []
    if standardise:
        source = f"{features}Scaled"
        stages.append(StandardScaler(inputCol=features, outputCol=source, withMean=False))
    stages.append(PCA(k=k, inputCol=source, outputCol="pcaFeatures"))
    return Pipeline(stages=stages).fit(df)


def covariances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the sample covariance matrix in long form, in one pass."""
    columns = list(columns)
    entries = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.covar_samp(a, b).alias("covariance"))
        for i, a in enumerate(columns)
        for b in columns[i:]
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def component_invariants(projected: DataFrame, output: str = "pcaFeatures", least: float = 1e-6) -> DataFrame:
    """What must hold of a full set of principal components: their count, the sum of their variances, and the largest
    correlation between two of them that vary at all, by more than ``least`` (measure, value).

    Both matrices of sums are added up from task to task, as the components themselves are, and have a row for each slot.
    """
    variances = projected.select(Summarizer.variance(F.col(output))).first()[0].toArray()
    found = Correlation.corr(projected, output).first()[0].toArray()
    varying = np.flatnonzero(variances > least)
    between = np.abs(found[np.ix_(varying, varying)]) - np.eye(len(varying))
    named = [
        ("components", float(len(variances))),
        ("variance", float(variances.sum())),
        ("largest_correlation", float(np.max(between, initial=0.0))),
    ]
    return projected.sparkSession.createDataFrame(named, "measure string, value double")


# --- splits -----------------------------------------------------------------------------------------


def split_point(key: Sequence[str], seed: int = V.SPLIT_SEED) -> Column:
    """A fixed number in [0, 1) per row, from the row's own key."""
    return hash32(*key, F.lit(seed)) / F.lit(2.0**32)


def hash_split(
    df: DataFrame, key: Sequence[str], share: float = 0.7, seed: int = V.SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Split by row key. Membership depends on the row alone, so it survives another partitioning,
    a lost executor and a rerun; a random split promises none of these."""
    at = split_point(key, seed)
    return df.where(at < F.lit(share)), df.where(at >= F.lit(share))


def random_split(df: DataFrame, share: float = 0.7, seed: int = V.SPLIT_SEED):
    """The library's own split; the sets change with the number of partitions."""
    return tuple(df.randomSplit([share, 1 - share], seed))


# --- feature selection ----------------------------------------------------------------------------


def feature_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample variance of every column, in one pass."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.var_samp(c).alias("variance")) for c in columns
    ]
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def anova_scores(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way F value of each column across the classes, from one pass over the rows.

    Per-class counts, means and spreads are taken first; the F values follow from those few rows.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.count(c).alias("n"),
                F.avg(c).alias("m"),
                F.coalesce(F.var_pop(c) * F.count(c), F.lit(0.0)).alias("inside"),
            )
            for c in columns
        ]
    )
    per_class = (
        df.groupBy(label).agg(entries.alias("entries")).select(label, F.inline("entries"))
    ).where(F.col("n") > 0)
    feature = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("m")).over(feature) / F.sum("n").over(feature)
    between = F.sum(F.col("n") * F.pow(F.col("m") - F.col("grand"), 2))
    classes, total = F.count(F.lit(1)), F.sum("n")
    return (
        per_class.withColumn("grand", grand)
        .groupBy("feature")
        .agg(
            F.try_divide(between / (classes - 1), F.sum("inside") / (total - classes)).alias(
                "f_value"
            )
        )
    )


def select_by_variance(df: DataFrame, threshold: float, features: str = "features"):
    return VarianceThresholdSelector(
        featuresCol=features, outputCol="selected", varianceThreshold=threshold
    ).fit(df)


def select_by_score(
    df: DataFrame, top: int, label: str = "label", features: str = "features", categorical=False
):
    """Keep the ``top`` features by F value, or by chi-squared for categorical features."""
    selector = UnivariateFeatureSelector(
        featuresCol=features, outputCol="selected", labelCol=label, selectionMode="numTopFeatures"
    )
    selector.setFeatureType("categorical" if categorical else "continuous")
    selector.setLabelType("categorical").setSelectionThreshold(top)
    return selector.fit(df)


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Slot names of an assembled vector, from its metadata."""
    attributes = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for group in attributes.values() for a in group)
    return [name for _, name in slots]


def vector_sums(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """Column sums of a vector column in long form.

    The vectors are added up as vectors, sparse ones by their filled slots only; what is unpacked
    into rows is the single summed vector.
    """
    summed = df.select(Summarizer.sum(F.col(features)).alias("sums"))
    labels = F.array(*[F.lit(n) for n in names])
    return summed.select(
        F.inline(F.arrays_zip(labels.alias("feature"), vector_to_array("sums").alias("total")))
    )
