"""File streams: mergeable counters over files as they arrive."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cytoframe.operators.matrix import Matrix
from cytoframe.sources.scratch import shared_folder


def watch(spark: SparkSession, folder: str, pattern: str, schema, *, files_a_trigger: int = 100) -> DataFrame:
    """Parquet files of a landing folder whose names fit the pattern, as a stream, existing ones first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).option("pathGlobFilter", pattern).parquet(folder)


def stop_asked(spark: SparkSession, folder: str) -> bool:
    """Whether a file whose name begins with STOP stands in the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/STOP*")
    return len(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)) > 0


def until_stop(query: StreamingQuery, folder: str, *, seconds: float = 1.0, give_up: float | None = None) -> None:
    """Lets a stream over a folder run until a file STOP* appears there (or so many seconds pass), takes in what is there then, and ends it."""
    spark, begin = SparkSession.active(), time.monotonic()
    while query.isActive and not stop_asked(spark, folder) and (give_up is None or time.monotonic() - begin < give_up):
        time.sleep(seconds)
    if query.isActive:
        query.processAllAvailable()
        query.stop()


def stream_counts(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Counts by event type over all files that are there now, by a streaming aggregation in complete mode."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    shared = shared_folder(spark)
    name = uuid.uuid4().hex
    counts = watch(spark, folder, pattern, schema).groupBy(F.col("event_type").alias("gene")).count()
    q = counts.writeStream.outputMode("complete").option("checkpointLocation", f"{shared}/stream-{name}").trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{shared}/counts-{name}")).start()
    q.awaitTermination()
    return spark.read.parquet(f"{shared}/counts-{name}")


def collect_umis(tags: DataFrame, path: str):
    """A stream yet to be started that adds the UMIs (gene, CB, UB) of each batch of tags, with their reads, to the tables under `path`.

    Each batch has a folder of its own, written anew if the batch runs again, so a UMI's reads count once whatever fails. What lies there
    at any time is a partial state that umis_so_far() merges. Returns a DataStreamWriter; the caller sets trigger and checkpoint.
    """

    def add(batch: DataFrame, number: int) -> None:
        batch.groupBy("gene", "CB", "UB").agg(F.count("*").alias("n_reads")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return tags.writeStream.foreachBatch(add)


def umis_so_far(spark: SparkSession, path: str) -> DataFrame:
    """Rows (gene, CB, UB, n_reads) of all batches."""
    return spark.read.parquet(path).groupBy("gene", "CB", "UB").agg(F.sum("n_reads").alias("n_reads"))


def matrix_so_far(umis: DataFrame) -> Matrix:
    """Distinct UMIs of each gene and cell; the unknown gene is left out."""
    return Matrix.from_values(umis.where("gene != '-'").groupBy(F.col("gene").alias("feature"), F.col("CB").alias("cell")).agg(F.count("*").alias("value")))


def saturation_so_far(umis: DataFrame) -> DataFrame:
    """One row: reads, UMIs and the saturation 1 - UMIs / reads."""
    one = umis.agg(F.coalesce(F.sum("n_reads"), F.lit(0)).alias("n_reads"), F.count("*").alias("n_umis"))
    return one.withColumn("saturation", F.coalesce(1 - F.try_divide("n_umis", "n_reads"), F.lit(0.0)))
