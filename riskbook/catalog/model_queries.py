"""Fitted models over the loan table. Only what SQL can recompute has an SQL twin."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.distribution_queries import rounded
from riskbook.catalog.exploration_queries import BAD
from riskbook.catalog.feature_queries import BAYES, LABELLED, MEASURES, labelled
from riskbook.catalog.registry import query
from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import bad_label, employment_years
from riskbook.operators import evaluation, models, tuning
from riskbook.operators import features as X
from riskbook.plans import training as P


def table(df: DataFrame) -> DataFrame:
    return X.add_weight(P.stored(P.model_table(df.drop("half_missing", "raw_amount"))))


def predictions(df: DataFrame, name: str) -> DataFrame:
    """Held-out loans per label and prediction, with the mean score of class 0."""
    train, test = P.split(table(df))
    scored = P.fit_models(train, {name: models.estimator(name)})[name].transform(test)
    source = "probability" if "probability" in scored.columns else "rawPrediction"
    return scored.groupBy("label", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.avg(vector_to_array(source)[0]).alias("mean_score")
    )


for _query, _model in (
    ("lr_predictions", "logistic"),
    ("rf_predictions", "forest"),
    ("gbt_predictions", "boosted"),
    ("svc_predictions", "svm"),
):

    @query(_query)
    def _(df, name=_model):
        return predictions(df, name)


@query(
    "nb_predictions",
    f"""
    WITH {LABELLED}, r AS (SELECT CAST(sum(ClassLable) AS DOUBLE) / count(*) AS r FROM labelled),
    x AS (
        SELECT ClassLable, CASE WHEN ClassLable = 0 THEN r ELSE 1 - r END AS w, loan_amnt, int_rate,
               dti, total_acc,
               CASE emp_length WHEN 'n/a' THEN 0 WHEN '< 1 year' THEN 0 WHEN '10+ years' THEN 10
                    ELSE CAST(split_part(emp_length, ' ', 1) AS INTEGER) END AS emp_lengthIndex
        FROM labelled, r
    ), m AS (
        SELECT ClassLable, sum(w) AS w, {', '.join(f'sum(w * {c}) AS {c}' for c in BAYES)}
        FROM x GROUP BY 1
    ), t AS (SELECT *, sum(w) OVER () AS all_w, {' + '.join(BAYES)} AS total FROM m),
    p AS (
        SELECT ClassLable, ln(w + 50) - ln(all_w + 100) AS pi,
               {', '.join(f'ln({c} + 50) - ln(total + 50 * {len(BAYES)}) AS {c}' for c in BAYES)}
        FROM t
    ), s AS (
        SELECT x.ClassLable AS label,
               a.pi + {' + '.join(f'x.{c} * a.{c}' for c in BAYES)} AS good,
               b.pi + {' + '.join(f'x.{c} * b.{c}' for c in BAYES)} AS bad
        FROM x, (SELECT * FROM p WHERE ClassLable = 0) a, (SELECT * FROM p WHERE ClassLable = 1) b
    )
    SELECT CAST(label AS DOUBLE) AS label, CASE WHEN bad > good THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
               AS prediction, count(*) AS n
    FROM s GROUP BY 1, 2
    """,
)
def _(df):
    rows = X.add_weight(labelled(df)).withColumn("emp_lengthIndex", employment_years())
    packed = X.assembler(BAYES).transform(rows.select(X.LABEL, X.WEIGHT, *BAYES))
    points = packed.withColumn("label", F.col(X.LABEL).cast("double"))
    scored = models.score(models.bayes().fit(points), points)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("model_comparison")
def _(df):
    train, test = P.split(table(df))
    return P.compare_models(P.fit_models(train), test)


@query("forest_importances")
def _(df):
    train, _ = P.split(table(df))
    model = P.fit_models(train, {"forest": models.forest()})["forest"]
    return models.importances(model, model.transform(train))


# Values that every engine writes alike, as the folds are a hash of their texts.
FOLD_KEY = ["loan_amnt", "int_rate", "total_acc", "addr_state", "sub_grade"]

MODEL_NUMBERS = ("loan_amnt", "funded_amnt", "int_rate", "installment", "annual_inc", "dti", "total_acc")


def encoded_sql(fit: str = "true", folds: int = 10) -> str:
    """CTEs to ``wide`` (one row for each cleaned loan) and ``long`` (one for each of its filled slots: f, x). Indexes and
    labels are ordered by their frequency among the rows that ``fit`` takes."""
    indexes = ", ".join(
        f"(SELECT i.place FROM (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS place"
        f" FROM cleaned WHERE {fit} GROUP BY {c}) i WHERE i.v = cleaned.{c}) AS {c}Index"
        for c in V.TWO_VALUED_CATEGORIES
    )
    years = (
        "CASE emp_length WHEN 'n/a' THEN 0 WHEN '< 1 year' THEN 0 WHEN '10+ years' THEN 10"
        " ELSE CAST(split_part(emp_length, ' ', 1) AS INTEGER) END"
    )
    numbers = [*MODEL_NUMBERS, *[f"{c}Index" for c in V.TWO_VALUED_CATEGORIES], "years"]
    slots = [f"{{'f': '{c}', 'x': CAST({c} AS DOUBLE)}}" for c in numbers]
    slots += [f"{{'f': '{c}_' || {c}, 'x': 1.0::DOUBLE}}" for c in V.MANY_VALUED_CATEGORIES]
    key = " || '|' || ".join(
        f"CAST(CAST({c} AS DOUBLE) AS VARCHAR)" if c in MODEL_NUMBERS else c for c in FOLD_KEY
    )
    return f"""
    cleaned AS (
        SELECT *, {BAD} AS y, CAST('0x' || substr(md5(id || '|1395'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS spot
        FROM loans
        WHERE annual_inc IS NOT NULL
          AND (tot_cur_bal IS NOT NULL OR loan_status IN ('Fully Paid', 'Charged Off'))
    ), r AS (SELECT CAST(sum(y) AS DOUBLE) / count(*) AS r FROM cleaned),
    classes AS (
        SELECT y, CAST(row_number() OVER (ORDER BY count(*) DESC, y) - 1 AS DOUBLE) AS label
        FROM cleaned WHERE {fit} GROUP BY y
    ), wide AS (
        SELECT row_number() OVER () AS row_id, label, abs(y - r) AS w, {years} AS years, {indexes},
               cleaned.* EXCLUDE (y), CAST('0x' || substr(md5({key} || '|1395'), 1, 8) AS BIGINT) % {folds} AS fold
        FROM cleaned JOIN classes USING (y) CROSS JOIN r
    ), long AS (
        SELECT row_id, spot, fold, label, w, unnest([{', '.join(slots)}], recursive := true) FROM wide
    )
    """


def bayes_predictions_sql(smoothing: float = 50.0, share: float = 0.7) -> str:
    """Naive Bayes from the rows below the split point, scores of those above it."""
    return f"""
    WITH {encoded_sql(f"spot < {share}")},
    mass AS (SELECT label, f, sum(w * x) AS m FROM long WHERE spot < {share} GROUP BY ALL),
    weight AS (SELECT label, sum(w) AS w FROM wide WHERE spot < {share} GROUP BY ALL),
    slots AS (SELECT count(DISTINCT f) AS d FROM mass),
    theta AS (
        SELECT t.label, a.f, ln(coalesce(m.m, 0) + {smoothing}) - ln(t.total + {smoothing} * d) AS theta
        FROM (SELECT label, sum(m) AS total FROM mass GROUP BY ALL) t CROSS JOIN slots
        CROSS JOIN (SELECT DISTINCT f FROM mass) a LEFT JOIN mass m ON m.label = t.label AND m.f = a.f
    ), pi AS (SELECT label, ln(w + {smoothing}) - ln(sum(w) OVER () + 2 * {smoothing}) AS pi FROM weight),
    scores AS (
        SELECT row_id, long.label, t.label AS guess, sum(x * theta) + any_value(pi) AS score
        FROM long JOIN theta t USING (f) JOIN pi ON pi.label = t.label WHERE spot >= {share} GROUP BY ALL
    ), pairs AS (
        SELECT row_id, label, max(score) FILTER (guess = 0) AS good, max(score) FILTER (guess = 1) AS bad
        FROM scores GROUP BY ALL
    )
    SELECT label, CASE WHEN bad > good THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction, count(*) AS n,
           round(avg(1 / (1 + exp(least(greatest(bad - good, -700), 700)))), 6) AS mean_score
    FROM pairs GROUP BY 1, 2
    """


def bayes_search_sql(folds: int = 10) -> str:
    """The whole search over long rows: encoded features, sums per fold, parameters, scores and accuracies."""
    return f"""
    WITH {encoded_sql(folds=folds).rstrip()[:-1]}
    ), mass AS (SELECT fold, label, f, sum(w * x) AS m FROM long GROUP BY ALL),
    weight AS (SELECT fold, label, sum(w) AS w FROM wide GROUP BY ALL),
    grid AS (
        SELECT k.fold, s.smoothing FROM (SELECT unnest(range({folds})) AS fold) k, (SELECT unnest([1.0, 2.0, 3.0]) AS smoothing) s
    ), sums AS (
        SELECT grid.fold, smoothing, label, f, sum(m) AS m FROM grid JOIN mass ON mass.fold <> grid.fold GROUP BY ALL
    ), slots AS (SELECT count(DISTINCT f) AS d FROM mass),
    theta AS (
        SELECT t.fold, t.smoothing, t.label, a.f,
               ln(coalesce(s.m, 0) + t.smoothing) - ln(t.total + t.smoothing * d) AS theta
        FROM (SELECT fold, smoothing, label, sum(m) AS total FROM sums GROUP BY ALL) t
        CROSS JOIN slots CROSS JOIN (SELECT DISTINCT f FROM mass) a
        LEFT JOIN sums s ON s.fold = t.fold AND s.smoothing = t.smoothing AND s.label = t.label AND s.f = a.f
    ), heavy AS (
        SELECT grid.fold, smoothing, label, sum(w) AS w FROM grid JOIN weight ON weight.fold <> grid.fold
        GROUP BY grid.fold, smoothing, label
    ), pi AS (
        SELECT fold, smoothing, label,
               ln(w + smoothing) - ln(sum(w) OVER (PARTITION BY fold, smoothing) + 2 * smoothing) AS pi
        FROM heavy
    ), scores AS (
        SELECT long.row_id, long.fold, long.label, t.smoothing, t.label AS guess, sum(x * theta) + any_value(pi) AS score
        FROM long JOIN theta t ON t.fold = long.fold AND t.f = long.f
        JOIN pi ON pi.fold = t.fold AND pi.smoothing = t.smoothing AND pi.label = t.label
        GROUP BY ALL
    ), guesses AS (
        SELECT row_id, fold, label, smoothing, arg_max(guess, score) AS guess FROM scores GROUP BY ALL
    ), accuracies AS (
        SELECT fold, smoothing, avg(CASE WHEN guess = label THEN 1.0::DOUBLE ELSE 0 END) AS a FROM guesses GROUP BY ALL
    ), ranked AS (
        SELECT 'smoothing=' || smoothing AS parameters, avg(a) AS mean, stddev_pop(a) AS deviation
        FROM accuracies GROUP BY smoothing
    )
    SELECT CAST(row_number() OVER (ORDER BY round(mean, 12) DESC, parameters) AS INTEGER) AS rank, parameters,
           round(mean, 9) AS mean_accuracy, round(deviation, 9) AS std_accuracy
    FROM ranked
    """


@query("nb_test_predictions", bayes_predictions_sql())
def _(df):
    return rounded(predictions(df, "bayes"), 6, ["mean_score"])


@query("cv_table_bayes", bayes_search_sql())
def _(df):
    """All 30 fits from the sums of one pass."""
    table_ = tuning.tune("bayes", table(df).drop(P.SPLIT_POINT), key=FOLD_KEY).table
    return rounded(table_, 9, ["mean_accuracy", "std_accuracy"])


# The full grids on ten folds: 270, 320, 270 and 90 settings.
for _query, _model in (
    ("cv_table", "logistic"),
    ("cv_table_forest", "forest"),
    ("cv_table_boosted", "boosted"),
    ("cv_table_svm", "svm"),
):

    @query(_query)
    def _(df, name=_model):
        return tuning.tune(name, table(df).drop(P.SPLIT_POINT), key=FOLD_KEY).table


@query("grade_prediction")
def _(df):
    train, test = P.split(table(df))
    model = P.grade_model(train)
    rows = test.drop(X.LABEL).withColumnRenamed("grade", "grade_label")
    return model.transform(rows).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("pca_model_accuracy")
def _(df):
    """Logistic regression on three principal components, scored on held-out loans."""
    train, test = P.split(table(df))
    model = P.fit_on_components(train, models.logistic(features="pcaFeatures", maxIter=10))
    return evaluation.ratios(evaluation.confusion_counts(model.transform(test)))


# --- what a fitted model must fulfil, against plain SQL ---------------------------------------------------


@query(
    "lr_score_equations",
    f"""
    WITH {LABELLED}, r AS (SELECT CAST(sum(ClassLable) AS DOUBLE) / count(*) AS r FROM labelled),
    x AS (SELECT *, abs(ClassLable - r) AS w FROM labelled, r)
    SELECT 'weight' AS feature, round(sum(w * ClassLable) / sum(w), 4) AS mean FROM x
    """
    + " ".join(
        f"UNION ALL SELECT '{c}', round(sum(w * ClassLable * {c}) / sum(w * {c}), 4) FROM x" for c in MEASURES
    ),
)
def _(df):
    """At the maximum of the likelihood the predicted defaults weigh, in every measure, what the observed ones weigh."""
    rows = X.add_weight(labelled(df)).select(X.WEIGHT, F.col(X.LABEL).cast("double").alias("label"), *MEASURES)
    packed = X.assembler(MEASURES).transform(rows)
    scored = models.logistic(maxIter=200, tol=1e-12).fit(packed).transform(packed)
    w, p = F.col(X.WEIGHT), vector_to_array("probability")[1]
    parts = [("weight", F.lit(1.0)), *[(c, F.col(c)) for c in MEASURES]]
    shares = [
        F.struct(F.lit(name).alias("feature"), F.round(F.sum(w * p * x) / F.sum(w * x), 4).alias("mean"))
        for name, x in parts
    ]
    return scored.agg(F.array(*shares).alias("shares")).select(F.inline("shares"))


@query("grade_score_equations", "SELECT grade, CAST(count(*) AS DOUBLE) AS expected FROM loans GROUP BY 1")
def _(df):
    """A fitted model of several classes expects as many loans of each grade as there are."""
    rows = df.select("grade", *MEASURES).withColumn("label", F.ascii("grade").cast("double") - 65)
    packed = X.assembler(MEASURES).transform(rows)
    fitted = models.logistic(weight=None, maxIter=200, tol=1e-12, family="multinomial").fit(packed)
    each = F.posexplode(vector_to_array("probability")).alias("class", "p")
    return fitted.transform(packed).select(each).groupBy("class").agg(F.sum("p").alias("p")).select(
        F.char(F.col("class") + 65).alias("grade"), F.round("p", 0).alias("expected")
    )


SPLIT_COLUMNS = ("total_acc", "dti")



def first_split_sql(label: str) -> str:
    return f"""
    WITH v AS (
        {' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, {label} AS y FROM loans" for c in SPLIT_COLUMNS)}
    ), g AS (SELECT feature, x, count(*) AS n, sum(y) AS bad FROM v GROUP BY 1, 2),
    c AS (
        SELECT feature, x, sum(n) OVER up AS n_l, sum(bad) OVER up AS b_l,
               sum(n) OVER (PARTITION BY feature) AS n, sum(bad) OVER (PARTITION BY feature) AS b
        FROM g WINDOW up AS (PARTITION BY feature ORDER BY x)
    ), best AS (
        SELECT feature, x FROM c WHERE n_l < n
        ORDER BY b_l * (n_l - b_l) / n_l::DOUBLE + (b - b_l) * (n - n_l - b + b_l) / (n - n_l)::DOUBLE LIMIT 1
    )
    SELECT best.feature, CASE WHEN v.x <= best.x THEN 'low' ELSE 'high' END AS side, count(*) AS n,
           CAST(sum(y) AS BIGINT) AS bad, min(v.x) AS lowest, max(v.x) AS highest
    FROM v JOIN best USING (feature) GROUP BY 1, 2
    """


def leaves(tree, rows: DataFrame) -> DataFrame:
    """The two sides of a tree's only split."""
    at = int(tree.featureImportances.indices[0])
    feature = SPLIT_COLUMNS[at]
    placed = tree.setLeafCol("leaf").transform(rows).withColumn("x", F.col(feature).cast("double"))
    sides = placed.groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("bigint")).alias("bad"),
        F.min("x").alias("lowest"), F.max("x").alias("highest"),
    )
    return sides.select(
        F.lit(feature).alias("feature"), F.when(F.col("leaf") == 0, "low").otherwise("high").alias("side"),
        "n", "bad", "lowest", "highest",
    )


def split_rows(df: DataFrame, label: Column) -> DataFrame:
    return X.assembler(SPLIT_COLUMNS).transform(df.select(label.cast("double").alias("label"), *SPLIT_COLUMNS))


# The library takes a split back whose sides predict the same class, so this label is one that the columns tell.
@query("forest_first_split", first_split_sql("CASE WHEN grade IN ('A', 'B') THEN 1 ELSE 0 END"))
def _(df):
    """A single tree of one level splits where the weighted Gini impurity falls most."""
    rows = split_rows(df, F.col("grade").isin("A", "B"))
    single = models.forest(maxDepth=1, numTrees=1, featureSubsetStrategy="all", maxBins=128, bootstrap=False)
    return leaves(single.fit(rows).trees[0], rows)


@query("boosted_first_split", first_split_sql(BAD))
def _(df):
    """The first boosted tree splits where the variance of the labels falls most."""
    rows = split_rows(df, bad_label())
    first = models.boosted(maxDepth=1, maxIter=1, maxBins=128).fit(rows)
    return leaves(first.trees[0], rows)


@query(
    "pca_whole_vector",
    f"""
    WITH rows AS (
        SELECT * FROM loans WHERE annual_inc IS NOT NULL
          AND (tot_cur_bal IS NOT NULL OR loan_status IN ('Fully Paid', 'Charged Off'))
    ), d AS (
        SELECT {len(MODEL_NUMBERS) + len(V.TWO_VALUED_CATEGORIES) + 1}
               + {' + '.join(f'(SELECT count(DISTINCT {c}) FROM rows)' for c in V.MANY_VALUED_CATEGORIES)} AS d
    )
    SELECT 'components' AS measure, CAST(d AS DOUBLE) AS value FROM d
    UNION ALL SELECT 'variance', CAST(d AS DOUBLE) FROM d
    UNION ALL SELECT 'largest_correlation', 0.0::DOUBLE
    """,
)
def _(df):
    """All components of the whole encoded and standardised vector: every slot brings a variance of 1, which the
    components share out among them without correlation."""
    rows = table(df).drop(P.SPLIT_POINT)
    vectors = P.encoded(models.encoding_pipeline(rows).fit(rows), rows, ["features"], StorageLevel.DISK_ONLY)
    try:
        size = len(X.feature_names(vectors))
        projected = X.pca_model(vectors, size, standardise=True).transform(vectors)
        return rounded(X.component_invariants(projected.select("pcaFeatures")), 4, ["value"])
    finally:
        vectors.unpersist()
