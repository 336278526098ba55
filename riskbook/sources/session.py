"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# The JVM compiles no method above 8000 bytes of bytecode and interprets it instead. Told the same
# limit, Spark generates a wide projection as many small methods rather than a single huge one.
METHOD_LIMIT_SETTING = "spark.sql.codegen.hugeMethodLimit"
METHOD_LIMIT = "8000"
OPEN_COST_SETTING, SPLIT_SETTING = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"


def local_session(cpus: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8):
    """A session for tests and local runs. On a cluster, use the session that is already there."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskbook")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config(METHOD_LIMIT_SETTING, METHOD_LIMIT)
        .getOrCreate()
    )


@contextmanager
def wide_rows(spark: SparkSession):
    """Run actions over wide projections with the method limit set, then put the setting back."""
    before = spark.conf.get(METHOD_LIMIT_SETTING)
    spark.conf.set(METHOD_LIMIT_SETTING, METHOD_LIMIT)
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT_SETTING, before)


@contextmanager
def file_by_file(spark: SparkSession):
    """Start reading files of less than a split, each as a partition of its own, then put the setting back.

    Spark packs small files into partitions by size and cores, so that few narrow files hold many rows.
    """
    before = spark.conf.get(OPEN_COST_SETTING)
    spark.conf.set(OPEN_COST_SETTING, spark.conf.get(SPLIT_SETTING))
    try:
        yield
    finally:
        spark.conf.set(OPEN_COST_SETTING, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may fall back to a temporary
    folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    """One temporary folder for each local session."""
    return tempfile.mkdtemp(prefix="riskbook-")


def remove_at_exit(spark: SparkSession, path: str) -> str:
    """Have an intermediate folder removed when the session's process ends; gives the path back."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def remove_now(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
