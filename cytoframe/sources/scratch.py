"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTS = "spark.sql.shuffle.partitions"
ROWS_A_TASK = 500_000  # rows that a task tells apart or sorts; more of them take more tasks


def parts_for(spark: SparkSession, rows: int, a_task: int = ROWS_A_TASK) -> int:
    """Tasks for so many rows: spark.sql.shuffle.partitions, or more where those would get more than `a_task` rows each."""
    return max(int(spark.conf.get(PARTS)), -(-rows // a_task))


@contextmanager
def dealt_by_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For tables written inside: exchanges have parts_for(rows) partitions, of which adaptive execution puts small ones together."""
    before = spark.conf.get(PARTS)
    spark.conf.set(PARTS, str(parts_for(spark, rows)))
    try:
        yield
    finally:
        spark.conf.set(PARTS, before)


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of the default file system, which on a cluster must not be a local one."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    base = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if base.startswith("file:") and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/') if not base.startswith('file:') else ''}/tmp/cytoframe-shared"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: computed once, whatever reads it, and safe when executors go.

    The shuffle files of the write are dropped with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
