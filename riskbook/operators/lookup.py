"""Small per-group summaries: keeping them, and joining them back onto rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.sources.session import remove_at_exit, shared_folder


def materialised(summary: DataFrame, label: str = "summary") -> DataFrame:
    """The summary, written once to the shared folder and read from there.

    Before it runs, Spark takes the size of an aggregate to be about the size of its input, so a join with one
    would shuffle the big side as well. The size of a written table is known: Spark broadcasts it by its own
    threshold or joins it by shuffle, whatever it holds. Whatever reads it again does not compute it again, and
    no row passes through the driver. The files go when the session ends.
    """
    spark = summary.sparkSession
    path = remove_at_exit(spark, f"{shared_folder(spark)}/riskbook-{label}-{uuid4().hex}")
    summary.write.parquet(path)
    return spark.read.schema(summary.schema).parquet(path)


def in_parts(rows: DataFrame, most: int) -> DataFrame:
    """The rows in parts of some ``most``, one a core at least, so that what a task holds does not grow with the table. Spark
    alone packs files by bytes, and those of few narrow columns hold many rows; to be read ``file_by_file``."""
    return rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // most)))


def attach(
    rows: DataFrame, summary: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join bringing ``columns`` of the summary onto the rows; NULL keys match NULL keys."""
    side = summary.select(*[F.col(k).alias(f"_{k}") for k in keys], *columns)
    tests = [rows[k].eqNullSafe(side[f"_{k}"]) for k in keys]
    condition = reduce(lambda a, b: a & b, tests)
    return rows.join(side, condition, how).drop(*[f"_{k}" for k in keys])


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """The rows numbered from 0 in a stated order, without bringing them to one task.

    They are dealt out by ranges of the order and sorted in each part; counts per part, one row for each, give what lies
    before it. The numbered rows are kept, so that a number once given never changes.
    """
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    rows = materialised(ranged.withColumn("_part", F.shiftright("_place", 33)), "numbered")
    parts = rows.groupBy("_part").agg(F.min("_place").alias("start"), F.count(F.lit(1)).alias("held"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
    placed = attach(rows, starts, ["_part"], ("start", "before"))
    return placed.select(*df.columns, (F.col("_place") - F.col("start") + F.col("before")).alias(name))
