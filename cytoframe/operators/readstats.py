"""Length and quality statistics of reads, by sample or any other key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions import seq


def measured(reads: DataFrame) -> DataFrame:
    """Reads with read_length and mean_quality (Phred of the mean error; null without bases)."""
    return reads.withColumns({"read_length": F.length("seq"), "mean_quality": seq.mean_quality(F.col("qual"))})


def passing(reads: DataFrame, *, min_quality: float | None = None, min_length: int = 0, max_length: int | None = None) -> DataFrame:
    """Measured reads within the bounds, which are inclusive; a read without bases has no quality and fails any bound on it."""
    out = reads.where(F.col("read_length") >= min_length) if min_length else reads
    out = out if max_length is None else out.where(F.col("read_length") <= max_length)
    return out if min_quality is None else out.where(F.col("mean_quality") >= min_quality)


def statistics(reads: DataFrame, *keys: str) -> DataFrame:
    """One row a key of measured reads: n_seqs, n_bases, min_length, max_length, mean_length and mean_quality (of the reads' own means)."""
    return reads.groupBy(*keys).agg(F.count("*").alias("n_seqs"), F.coalesce(F.sum("read_length"), F.lit(0)).alias("n_bases"), F.min("read_length").alias("min_length"), F.max("read_length").alias("max_length"), F.avg("read_length").alias("mean_length"), F.avg("mean_quality").alias("mean_quality"))


def histogram(reads: DataFrame, column: str, width: float, *keys: str) -> DataFrame:
    """Rows (keys, low, high, n): reads in bins of `width` of read_length or mean_quality, low included, high not; empty bins are left out."""
    number = F.floor(F.col(column) / width)
    return reads.where(F.col(column).isNotNull()).groupBy(*keys, number.alias("_b")).agg(F.count("*").alias("n")).select(*keys, (F.col("_b") * width).alias("low"), ((F.col("_b") + 1) * width).alias("high"), "n")


def half_length(reads: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, n50): the largest length such that reads of at least it hold half of a key's bases.

    Computed from the bases of each length, so a key's rows in the only window are as many as its distinct lengths.
    """
    each = reads.where("read_length > 0").groupBy(*keys, "read_length").agg(F.sum("read_length").alias("_bases"))
    down = Window.partitionBy(*keys).orderBy(F.desc("read_length"))
    total = Window.partitionBy(*keys)
    run = each.select(*keys, "read_length", F.sum("_bases").over(down).alias("_run"), F.sum("_bases").over(total).alias("_all"))
    return run.where("2 * _run >= _all").groupBy(*keys).agg(F.max("read_length").alias("n50"))
