"""Reading tables, intermediate tables in the shared folder, and small helpers for all operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbook.sources.session import shared_folder

# Words are runs of anything but the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders of this session's intermediate tables that are still there.
_FOLDERS: list[str] = []


class Scope:
    """The folders that :func:`stored` writes within ``with scope:``, after those of an earlier scope."""

    _open: list[Scope] = []

    def __init__(self, before: Scope | None = None) -> None:
        self.name = uuid.uuid4().hex
        self.before = before
        self.folders: list[str] = []

    def __enter__(self) -> Scope:
        Scope._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scope._open.pop()

    def discard_all_but(self, docs: DataFrame) -> None:
        """Remove the tables of this scope and those before it that ``docs`` does not read."""
        read = docs.inputFiles() if self.folders or self.before else []
        scope: Scope | None = self
        while scope is not None:
            for path in list(scope.folders):
                name = path.rsplit("/", 1)[-1]
                if not any(f"/{name}/" in file for file in read):
                    scope.folders.remove(path)
                    if path in _FOLDERS:
                        _remove(docs.sparkSession, path)
            scope = scope.before


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    This cuts the lineage: a lost executor recomputes nothing before this point, and row numbers given
    in the written table never change. The folder is removed when the session ends, or earlier by
    :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/riskbook-llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    system, target = _hadoop_path(spark, path)
    system.deleteOnExit(target)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    _FOLDERS.append(path)
    if Scope._open:
        Scope._open[-1].folders.append(path)
    return back


def _remove(spark: SparkSession, path: str) -> None:
    system, target = _hadoop_path(spark, path)
    system.delete(target, True)
    if path in _FOLDERS:
        _FOLDERS.remove(path)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, table.stored_at)


def whole(text: str | Column) -> Column:
    """A text column in which NULL is the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def in_sample(columns: list[str], seed: int, most: int, total: int) -> Column:
    """Whether a hash of the columns falls into the share that holds about ``most`` of ``total`` rows. The share is a
    threshold among 2**63 hashes, so it never rounds to nothing, whatever the size of the table."""
    if total <= most:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 1) < F.lit((2**63 * most) // total)
