"""Streams that end by a file, and batches that run again."""

import threading

from pyspark.sql import functions as F

from cytoframe.sources.scratch import scratch_path
from cytoframe.streaming import ingest


def test_stream_runs_until_a_stop_file(spark):
    folder, out = scratch_path(spark, "landing"), scratch_path(spark, "state")
    rows = lambda a, b: spark.range(a, b).select(F.lit("g").alias("gene"), (F.col("id") % 3).cast("string").alias("CB"), (F.col("id") % 10).cast("string").alias("UB")).coalesce(1)
    rows(0, 30).write.parquet(f"{folder}")
    tags = ingest.watch(spark, folder, "*.parquet", rows(0, 1).schema, files_a_trigger=1)
    q = ingest.collect_umis(tags, out).option("checkpointLocation", scratch_path(spark, "check")).trigger(processingTime="200 milliseconds").start()

    def later():
        rows(100, 130).write.mode("append").parquet(folder)
        fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/STOP.fastq")).close()

    threading.Timer(2, later).start()
    ingest.until_stop(q, folder, seconds=0.3, give_up=60)
    assert not q.isActive
    umis = ingest.umis_so_far(spark, out)
    assert umis.agg(F.sum("n_reads")).first()[0] == 60 and umis.count() == 30
    assert ingest.matrix_so_far(umis).values.agg(F.sum("value")).first()[0] == 30
    assert ingest.saturation_so_far(umis).first().saturation == 0.5
