"""Loan files, views, schema reports and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbook.operators.cleaning import null_profile


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_loans_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    header: bool = True,
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read a loan CSV with every column as text, leaving out malformed lines.

    Lines are judged on all their columns, whatever the query reads: with the parser's own column
    pruning a count, a narrow select and a full read would each keep a different set of lines.
    Parsing text is the dearest way to scan; ``write_table`` turns it into Parquet once.

    ``infer=True`` costs a second pass over the text to guess types. ``multiline=True`` allows line
    breaks inside quotes, but a file can then not be split between tasks.
    """
    reader = spark.read.options(
        header=header,
        mode="DROPMALFORMED",
        multiLine=multiline,
        columnPruning=False,
        inferSchema=infer,
    )
    if columns is not None and not infer:
        reader = reader.schema(text_schema(columns))
    return reader.csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write Parquet and read it back: later scans prune columns and row groups."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name the current plan for SQL. Register again after adding columns: a view is a snapshot."""
    df.createOrReplaceTempView(name)
    return df


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and number of filled values of every column, in one pass."""
    names = [F.lit(f.name) for f in df.schema.fields]
    types = [F.lit(f.dataType.simpleString()) for f in df.schema.fields]
    return null_profile(df).select(
        F.array_position(F.array(*names), F.col("column")).alias("position"),
        "column",
        F.element_at(
            F.array(*types), F.array_position(F.array(*names), F.col("column")).cast("int")
        ).alias("type"),
        (F.col("rows") - F.col("nulls")).alias("filled"),
    )


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order (a distributed top-n, never a full sort)."""
    return df.orderBy(*order).limit(n)
