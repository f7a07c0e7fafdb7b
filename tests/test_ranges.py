"""Alignments written in order by many tasks, and merged records that nothing exchanges."""

from pyspark.sql import functions as F

from cytoframe.plans import runs
from cytoframe.sources import alignments, merging
from cytoframe.sources.scratch import scratch_path

DATA = "/root/testdata/sf0.001"


def test_unmapped_reads_fall_to_many_files(spark):
    path = scratch_path(spark, "ranges")
    rows = spark.range(4000).select(F.col("id").cast("string").alias("read_id"), F.lit(4).alias("flag"), F.lit("*").alias("chr"), F.lit(5).alias("start"), F.lit(0).alias("mapq"), F.lit("*").alias("cigar"), F.lit("*").alias("seq"), F.lit("*").alias("qual"), F.create_map(F.lit("AS"), F.lit("1")).alias("tags"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        alignments.write_sam(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [r["count"] for r in spark.read.text(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_records_without_exchange(spark):
    found = merging.merge_alignments(spark, runs._aligned(spark, DATA), keep_unaligned=False)
    assert "rangepartitioning" not in found.records._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.records.columns) == sorted(found.rows.columns)
    key = ["sample", "read_id", "flag", "chr", "start", "cigar"]
    assert sorted(map(tuple, found.records.select(*key).collect())) == sorted(map(tuple, found.rows.select(*key).collect()))
    ranged = merging.contigs_with_reads(found.rows)
    assert sorted(map(tuple, merging.contigs_with_reads(found.records).collect())) == sorted(map(tuple, ranged.collect()))
    assert "rangepartitioning" not in runs.alignment_contigs(spark, DATA)._jdf.queryExecution().executedPlan().toString()
