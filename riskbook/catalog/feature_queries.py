"""Labels, weights, encodings, splits and feature statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.distribution_queries import rounded
from riskbook.catalog.exploration_queries import BAD
from riskbook.catalog.registry import query
from riskbook.functions import vocabulary as V
from riskbook.functions.expressions import bad_label, employment_years
from riskbook.operators import features as X
from riskbook.operators.models import bayes_parameters
from riskbook.operators.tuning import with_folds

MEASURES = ("loan_amnt", "int_rate", "installment", "dti", "total_acc")


def labelled(df: DataFrame) -> DataFrame:
    return df.withColumn(X.LABEL, bad_label())


LABELLED = f"labelled AS (SELECT *, {BAD} AS ClassLable FROM loans)"


@query(
    "default_label", f"SELECT loan_status, {BAD} AS ClassLable, count(*) AS n FROM loans GROUP BY 1, 2"
)
def _(df):
    return labelled(df).groupBy(V.STATUS, X.LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(
    "class_balance",
    f"""
    WITH {LABELLED}
    SELECT ClassLable, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM loans) AS share
    FROM labelled GROUP BY 1
    """,
)
def _(df):
    return X.class_balance(labelled(df))


@query(
    "class_weight",
    f"""
    WITH {LABELLED}, r AS (SELECT CAST(sum(ClassLable) AS DOUBLE) / count(*) AS r FROM labelled)
    SELECT ClassLable, CASE WHEN ClassLable = 0 THEN r ELSE 1 - r END AS weightColumn, count(*) AS n
    FROM labelled, r GROUP BY 1, 2
    """,
)
def _(df):
    weighted = X.add_weight(labelled(df))
    return weighted.groupBy(X.LABEL, X.WEIGHT).agg(F.count(F.lit(1)).alias("n"))


@query(
    "published_class_weight",
    f"""
    WITH {LABELLED}
    SELECT CASE WHEN ClassLable = 0 THEN 0.0735::DOUBLE ELSE 1 - 0.0735::DOUBLE END AS weightColumn,
           count(*) AS n
    FROM labelled GROUP BY 1
    """,
)
def _(df):
    weighted = X.add_weight(labelled(df), ratio=V.PUBLISHED_BALANCE)
    return weighted.groupBy(X.WEIGHT).agg(F.count(F.lit(1)).alias("n"))


@query(
    "string_index",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", {c} AS value, count(*) AS n,
               CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS index
        FROM loans GROUP BY {c}
        """
        for c in V.TWO_VALUED_CATEGORIES
    ),
)
def _(df):
    columns = list(V.TWO_VALUED_CATEGORIES)
    indexed = X.string_indexer(columns).fit(df).transform(df)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(c).alias("value"),
                F.col(X.index_column(c)).alias("index"),
            )
            for c in columns
        ]
    )
    return (
        indexed.select(F.inline(pairs))
        .groupBy("column", "value", "index")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def one_hot_sql(column: str, values) -> str:
    flags = ", ".join(
        f"sum(CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END)::BIGINT AS {column}_{v}" for v in values
    )
    return f"SELECT term, {flags} FROM loans GROUP BY 1"


@query("one_hot_grade", one_hot_sql("grade", V.GRADE_ORDER))
def _(df):
    wide = X.one_hot_columns(df, ["grade"])
    return wide.groupBy("term").agg(*[F.sum(f"grade_{g}").alias(f"grade_{g}") for g in V.GRADE_ORDER])


@query("one_hot_subgrade", one_hot_sql("sub_grade", V.SUB_GRADE_ORDER))
def _(df):
    wide = X.one_hot_columns(df, ["sub_grade"])
    names = [f"sub_grade_{g}" for g in V.SUB_GRADE_ORDER]
    return wide.groupBy("term").agg(*[F.sum(n).alias(n) for n in names])


@query(
    "one_hot_wide_sums",
    " UNION ALL ".join(
        f"SELECT '{c}_' || {c} AS feature, CAST(count(*) AS DOUBLE) AS total FROM loans GROUP BY {c}"
        for c in V.MANY_VALUED_CATEGORIES
    ),
)
def _(df):
    columns = list(V.MANY_VALUED_CATEGORIES)
    wide = X.one_hot_columns(df.select(*columns), columns)
    flags = [c for c in wide.columns if c not in columns]
    return X.vector_sums(X.assembler(flags).transform(wide).select("features"), flags)


@query(
    "one_hot_vector_sums",
    " UNION ALL ".join(
        f"SELECT '{c}Vec_' || {c} AS feature, CAST(count(*) AS DOUBLE) AS total FROM loans GROUP BY {c}"
        for c in V.MANY_VALUED_CATEGORIES
    ),
)
def _(df):
    columns = list(V.MANY_VALUED_CATEGORIES)
    indexed = X.string_indexer(columns).fit(df.select(*columns)).transform(df.select(*columns))
    hot = X.one_hot_encoder(columns).fit(indexed).transform(indexed)
    packed = X.assembler([X.vector_column(c) for c in columns]).transform(hot).select("features")
    return X.vector_sums(packed, X.feature_names(packed))


@query(
    "wide_model_table",
    f"""
    WITH {LABELLED}, r AS (SELECT CAST(sum(ClassLable) AS DOUBLE) / count(*) AS r FROM labelled)
    SELECT ClassLable, count(*) AS n,
           sum(CASE WHEN grade = 'B' THEN 1 ELSE 0 END)::BIGINT AS grade_B,
           sum(CASE WHEN purpose = 'car' THEN 1 ELSE 0 END)::BIGINT AS purpose_car,
           sum(CASE emp_length WHEN 'n/a' THEN 0 WHEN '< 1 year' THEN 0 WHEN '10+ years' THEN 10
                    ELSE CAST(split_part(emp_length, ' ', 1) AS INTEGER) END)::BIGINT AS emp_lengthIndex,
           max(CASE WHEN ClassLable = 0 THEN r ELSE 1 - r END) AS weightColumn
    FROM labelled, r GROUP BY 1
    """,
)
def _(df):
    source = df.withColumn("isDefault", bad_label()).drop("id", "loan_status", "issue_d")
    wide = X.encode_wide(source)
    return wide.groupBy(X.LABEL).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("grade_B").alias("grade_B"),
        F.sum("purpose_car").alias("purpose_car"),
        F.sum(X.EMPLOYMENT_INDEX).alias(X.EMPLOYMENT_INDEX),
        F.max(X.WEIGHT).alias(X.WEIGHT),
    )


@query(
    "assembled_sums",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(sum({c}), 2) AS total FROM loans"
        for c in ("int_rate", "dti", "total_acc")
    ),
)
def _(df):
    columns = ["int_rate", "dti", "total_acc"]
    packed = X.assembler(columns).transform(df.select(*columns))
    return rounded(X.vector_sums(packed, columns), 2, ["total"])


@query(
    "label_index",
    f"""
    WITH {LABELLED}
    SELECT ClassLable, count(*) AS n,
           CAST(row_number() OVER (ORDER BY count(*) DESC, ClassLable) - 1 AS DOUBLE) AS label
    FROM labelled GROUP BY 1
    """,
)
def _(df):
    rows = labelled(df).select(X.LABEL)
    indexed = X.label_indexer().fit(rows).transform(rows)
    return indexed.groupBy(X.LABEL, "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "index_to_text",
    "SELECT term, term AS term_text, count(*) AS n FROM loans GROUP BY 1, 2",
)
def _(df):
    model = X.string_indexer(["term"]).fit(df)
    back = X.index_to_text(model.transform(df), "termIndex", model.labelsArray[0], "term_text")
    return back.groupBy("term", "term_text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "hash_split",
    """
    WITH p AS (
        SELECT grade, CAST('0x' || substr(md5(id || '|1395'), 1, 8) AS BIGINT)
                      / 4294967296.0::DOUBLE AS spot
        FROM loans
    )
    SELECT grade, count(*) FILTER (spot < 0.7) AS train, count(*) FILTER (spot >= 0.7) AS test
    FROM p GROUP BY 1
    """,
)
def _(df):
    train, test = X.hash_split(df, ["id"])
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.groupBy("grade").agg(
        F.count_if(F.col("part") == "train").alias("train"),
        F.count_if(F.col("part") == "test").alias("test"),
    )


@query(
    "fold_counts",
    """
    SELECT CAST('0x' || substr(md5(id || '|1395'), 1, 8) AS BIGINT) % 10 AS fold, count(*) AS n
    FROM loans GROUP BY 1
    """,
)
def _(df):
    folds = with_folds(df, ["id"], 10)
    return folds.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "covariance_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(covar_samp({a}, {b}), 3) AS covariance FROM loans"
        for i, a in enumerate(MEASURES)
        for b in MEASURES[i:]
    ),
)
def _(df):
    return rounded(X.covariances(df, MEASURES), 3, ["covariance"])


@query(
    "feature_variances",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(var_samp({c}), 3) AS variance FROM loans" for c in MEASURES
    ),
)
def _(df):
    return rounded(X.feature_variances(df, MEASURES), 3, ["variance"])


def anova_sql(column: str) -> str:
    return f"""
    SELECT '{column}' AS feature,
           round(sum(c.n * (c.m - g.m) * (c.m - g.m)) / (count(*) - 1)
                 / (sum(c.inside) / (sum(c.n) - count(*))), 6) AS f_value
    FROM (SELECT ClassLable, count(*) AS n, avg({column}) AS m,
                 var_pop({column}) * count(*) AS inside FROM labelled GROUP BY 1) c,
         (SELECT avg({column}) AS m FROM labelled) g
    """


@query("anova_scores", f"WITH {LABELLED} " + " UNION ALL ".join(anova_sql(c) for c in MEASURES))
def _(df):
    return rounded(X.anova_scores(labelled(df), MEASURES, X.LABEL), 6, ["f_value"])


BAYES = ("loan_amnt", "int_rate", "dti", "total_acc", "emp_lengthIndex")


@query(
    "nb_parameters",
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
    ), t AS (SELECT *, sum(w) OVER () AS all_w, {' + '.join(BAYES)} AS total FROM m)
    """
    + " UNION ALL ".join(
        f"SELECT ClassLable, '{c}' AS feature, round(ln(w + 50) - ln(all_w + 100), 8) AS pi,"
        f" round(ln({c} + 50) - ln(total + 50 * {len(BAYES)}), 8) AS theta FROM t"
        for c in BAYES
    ),
)
def _(df):
    rows = X.add_weight(labelled(df)).withColumn("emp_lengthIndex", employment_years())
    return rounded(bayes_parameters(rows, BAYES, X.LABEL, X.WEIGHT), 8, ["pi", "theta"])


@query("pca_projection")
def _(df):
    """Spread of the three components over all loans, from standardised measures."""
    packed = X.assembler(MEASURES).transform(df.select(*MEASURES))
    projected = X.pca_model(packed, 3, standardise=True).transform(packed)
    parts = F.posexplode(X.vector_to_array("pcaFeatures")).alias("component", "x")
    return projected.select(parts).groupBy("component").agg(
        F.count("x").alias("n"), F.round(F.var_samp("x"), 6).alias("variance")
    )


@query(
    "feature_selection",
    f"WITH {LABELLED} SELECT * FROM ({' UNION ALL '.join(anova_sql(c) for c in MEASURES)})"
    " ORDER BY f_value DESC LIMIT 3",
)
def _(df):
    """The three measures that differ most between the classes, by the library's selector."""
    rows = labelled(df).select(X.LABEL, *MEASURES)
    packed = X.assembler(MEASURES).transform(rows)
    chosen = X.select_by_score(packed, 3, label=X.LABEL).selectedFeatures
    kept = [MEASURES[i] for i in sorted(chosen)]
    return rounded(X.anova_scores(rows, kept, X.LABEL), 6, ["f_value"])


# --- encodings without a limit on values ------------------------------------------------------------

# Loan amounts have nearly as many values as there are loans.
WIDE = ("grade", "purpose", "loan_amnt")
DICTIONARY = "d AS (SELECT *, row_number() OVER (ORDER BY place, n DESC, value) - 1 AS slot FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS place, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM loans GROUP BY {c}"
    for i, c in enumerate(WIDE)
) + "))"


@query("category_dictionary", f'WITH {DICTIONARY} SELECT "column", value, n, slot FROM d')
def _(df):
    return X.category_dictionary(df, WIDE)


@query(
    "long_encoding_sums",
    f"WITH {DICTIONARY}, l AS ("
    + " UNION ALL ".join(
        f"SELECT term, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM loans" for c in WIDE
    )
    + ') SELECT term, "column", slot, CAST(count(*) AS DOUBLE) AS total FROM l JOIN d USING ("column", value) GROUP BY ALL',
)
def _(df):
    encoded = X.long_encoding(df, ["id", "term"], WIDE)
    return encoded.groupBy("term", "column", "slot").agg(F.sum("x").alias("total"))


@query(
    "long_vector_sums",
    f"""
    WITH {DICTIONARY}, l AS (
        {" UNION ALL ".join(f"SELECT id, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM loans" for c in ("grade", "purpose"))}
    ) SELECT slot, CAST(count(DISTINCT id) AS DOUBLE) AS total FROM l JOIN d USING ("column", value) GROUP BY 1
    """,
)
def _(df):
    """The vectors made from the long form, added up as vectors."""
    columns = ["grade", "purpose"]
    dictionary = X.category_dictionary(df, columns)
    size = dictionary.count()
    distinct = df.dropDuplicates(["id"])
    packed = X.vectors_of(X.long_encoding(distinct, ["id"], columns, dictionary), ["id"], size)
    sums = X.vector_sums(packed, [str(i) for i in range(size)])
    return sums.select(F.col("feature").cast("bigint").alias("slot"), "total")


@query("feature_column_list", """
    SELECT name FROM (SELECT unnest(['loan_amnt', 'int_rate', 'weightless', 'termIndex', 'emp_lengthIndex']) AS name)
    WHERE name <> 'weightless'
    UNION ALL SELECT DISTINCT 'grade_' || grade FROM loans
""")
def _(df):
    """All columns of a wide table but label and weight."""
    source = df.select("loan_amnt", "int_rate", "term", "grade", "emp_length", bad_label().alias("isDefault"))
    wide = X.encode_wide(source)
    names = X.feature_columns(wide)
    return df.limit(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("name"))


@query(
    "labelled_point_sums",
    f"WITH {LABELLED} "
    + " UNION ALL ".join(
        f"SELECT CAST(ClassLable AS DOUBLE) AS label, '{c}' AS feature, round(sum({c}), 2) AS total FROM labelled GROUP BY 1"
        for c in ("int_rate", "dti", "total_acc")
    ),
)
def _(df):
    columns = ["int_rate", "dti", "total_acc"]
    points = X.labelled_points(X.assembler(columns).transform(labelled(df)), X.LABEL)
    summed = points.groupBy("label").agg(X.Summarizer.sum(F.col("features")).alias("s"))
    names = F.array(*[F.lit(c) for c in columns])
    each = summed.select("label", F.inline(F.arrays_zip(names.alias("feature"), X.vector_to_array("s").alias("total"))))
    return rounded(each, 2, ["total"])
