"""Model measures over a fixed rule, so that every number has an exact SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.catalog.distribution_queries import rounded
from riskbook.catalog.exploration_queries import BAD
from riskbook.catalog.registry import query
from riskbook.functions.expressions import bad_label
from riskbook.operators import evaluation as M

PREDICTION = "CASE WHEN int_rate >= 20 AND term = '36 months' THEN 1.0 ELSE 0.0 END"
RULE = f"""
rule AS (SELECT grade, CAST({BAD} AS DOUBLE) AS label, CAST({PREDICTION} AS DOUBLE) AS prediction,
                1 - ({BAD}) AS target, (40 - int_rate) / 40 AS score, loan_amnt AS margin FROM loans)
"""


def rule(df: DataFrame) -> DataFrame:
    label = bad_label().cast("double")
    flagged = (F.col("int_rate") >= 20) & (F.col("term") == "36 months")
    return df.select(
        "grade",
        label.alias("label"),
        F.when(flagged, 1.0).otherwise(0.0).alias("prediction"),
        (1 - bad_label()).alias("target"),
        ((40 - F.col("int_rate")) / 40).alias("score"),
        F.col("loan_amnt").alias("margin"),
    )


COUNTS = """
    count(*) AS total, count(*) FILTER (label = prediction) AS correct,
    count(*) FILTER (label <> prediction) AS wrong,
    count(*) FILTER (label = 0 AND prediction = 0) AS trueP,
    count(*) FILTER (label = 1 AND prediction = 1) AS trueN,
    count(*) FILTER (label = 1 AND prediction = 0) AS falseN,
    count(*) FILTER (label = 0 AND prediction = 1) AS falseP
"""


@query("confusion_counts", f"WITH {RULE} SELECT {COUNTS} FROM rule")
def _(df):
    return M.confusion_counts(rule(df))


@query("confusion_by_grade", f"WITH {RULE} SELECT grade, {COUNTS} FROM rule GROUP BY grade")
def _(df):
    return M.confusion_counts(rule(df), keys=["grade"])


@query(
    "classification_ratios",
    f"""
    WITH {RULE}, c AS (SELECT {COUNTS} FROM rule)
    SELECT *, round(wrong / total::DOUBLE, 9) AS ratio_wrong,
           round(correct / total::DOUBLE, 9) AS ratio_correct,
           round((trueP + trueN) / total::DOUBLE, 9) AS accuracy,
           round(100 * trueP / (trueP + falseP)::DOUBLE, 9) AS precision,
           round(100 * trueP / (trueP + falseN)::DOUBLE, 9) AS recall,
           round(100 * 2.0 * trueP / (2 * trueP + falseP + falseN)::DOUBLE, 9) AS f1,
           round(100 * trueP / (trueP + falseN)::DOUBLE, 9) AS sensitivity,
           round(100 * trueN / (trueN + falseP)::DOUBLE, 9) AS specificity,
           round(trueP / (trueP + falseN)::DOUBLE, 9) AS std_precision,
           round(trueP / (trueP + falseP)::DOUBLE, 9) AS std_recall,
           round(trueN / (trueN + falseN)::DOUBLE, 9) AS std_specificity,
           round(trueN / (trueN + falseP)::DOUBLE, 9) AS std_negative_predictive_value
    FROM c
    """,
)
def _(df):
    found = M.ratios(M.confusion_counts(rule(df)))
    shares = [c for c in found.columns if c in M.RATIOS or c.startswith("std_")]
    return rounded(found, 9, shares)


@query(
    "accuracy",
    f"WITH {RULE} SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM rule",
)
def _(df):
    return M.accuracy(rule(df))


def roc_sql(score: str) -> str:
    return f"""
    g AS (
        SELECT {score} AS threshold, count(*) FILTER (target = 1) AS hits,
               count(*) FILTER (target = 0) AS misses
        FROM rule GROUP BY 1
    ), p AS (
        SELECT threshold, hits, misses,
               CAST(sum(hits) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp,
               CAST(sum(misses) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
               CAST(sum(hits) OVER () AS BIGINT) AS all_hits,
               CAST(sum(misses) OVER () AS BIGINT) AS all_misses
        FROM g
    )
    """


for _suffix, _score in (("", "score"), ("_by_amount", "margin")):

    @query(
        f"roc_points{_suffix}",
        f"WITH {RULE}, {roc_sql(_score)} SELECT *, fp / all_misses::DOUBLE AS fpr,"
        " tp / all_hits::DOUBLE AS tpr FROM p",
    )
    def _(df, score=_score):
        return M.roc_points(rule(df), score)

    @query(
        f"roc_area{_suffix}",
        f"WITH {RULE}, {roc_sql(_score)} SELECT round(sum(misses * (tp + tp - hits) / 2.0)"
        " / (max(all_hits) * max(all_misses)::DOUBLE), 10) AS area FROM p",
    )
    def _(df, score=_score):
        return rounded(M.roc_area(M.roc_points(rule(df), score)), 10, ["area"])


@query(
    "roc_points_binned",
    f"""
    WITH {RULE}, {roc_sql('floor(score * 10) / 10')}
    SELECT *, fp / all_misses::DOUBLE AS fpr, tp / all_hits::DOUBLE AS tpr FROM p
    """,
)
def _(df):
    return M.roc_points(rule(df), bins=10)


@query(
    "evaluator_area",
    f"""
    WITH {RULE}, ranked AS (
        SELECT target, (2 * rank() OVER (ORDER BY score) + count(*) OVER (PARTITION BY score) - 1) / 2.0
            AS r
        FROM rule
    )
    SELECT grade_count AS loans,
           round((sum(r) FILTER (target = 1) - p * (p + 1) / 2.0) / (p * (grade_count - p)::DOUBLE), 8)
               AS area
    FROM ranked, (SELECT count(*) AS grade_count, CAST(sum(target) AS DOUBLE) AS p FROM rule)
    GROUP BY grade_count, p
    """,
)
def _(df):
    rows = rule(df).withColumn("target", F.col("target").cast("double"))
    area = M.evaluator_area(rows, label="target", raw="score", bins=0)
    return rows.agg(F.count(F.lit(1)).alias("loans"), F.round(F.lit(area), 8).alias("area"))


# Scores that differ by less than 0.0004 crowd in few slices of the line; a low bound has those cut again.
CROWDED = "0.5 + loan_amnt / 1e9"


def crowded(df: DataFrame) -> DataFrame:
    return rule(df).withColumn("score", 0.5 + F.col("margin") / 1e9)


CROWDED_RULE = f"rule AS (SELECT 1 - ({BAD}) AS target, {CROWDED} AS score FROM loans)"


@query(
    "roc_points_crowded",
    f"WITH {CROWDED_RULE}, {roc_sql('score')} SELECT *, fp / all_misses::DOUBLE AS fpr,"
    " tp / all_hits::DOUBLE AS tpr FROM p",
)
def _(df):
    return M.roc_points(crowded(df), most=200)


@query(
    "roc_area_crowded",
    f"""
    WITH {CROWDED_RULE}, {roc_sql('score')}
    SELECT round(sum(misses * (2 * tp - hits))::DOUBLE / (2 * max(all_hits)::DOUBLE * max(all_misses)), 12)
               AS area
    FROM p
    """,
)
def _(df):
    return rounded(M.roc_area(M.roc_points(crowded(df), most=200)), 12, ["area"])


@query(
    "roc_curve_thinned",
    f"""
    WITH {CROWDED_RULE}, {roc_sql('score')}
    SELECT *, fp / all_misses::DOUBLE AS fpr, tp / all_hits::DOUBLE AS tpr FROM p
    WHERE floor((tp + fp) * 50 / (all_hits + all_misses)::DOUBLE)
        > floor((tp + fp - hits - misses) * 50 / (all_hits + all_misses)::DOUBLE)
    """,
)
def _(df):
    return M.thinned(M.roc_points(crowded(df), most=200), 50)
