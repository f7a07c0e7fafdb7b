"""Fusion transcripts of single cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that tell fusions apart.
KEYS = ["FusionName", "LeftGene", "LeftBreakpoint", "RightGene", "RightBreakpoint", "SpliceType"]


def read_rows(fusions: DataFrame, reads: str = "LR_accessions") -> DataFrame:
    """One row for each read of the comma-separated list of each fusion; a read listed twice gives two."""
    return fusions.select(*KEYS, F.explode(F.split(reads, ",")).alias("read_id"))


def of_cells(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """Fusion reads with the cell CB and UMI UB of their read."""
    return rows.join(tags.select("read_id", "CB", "UB"), "read_id").select(*KEYS, "CB", "UB", "read_id")


def without_tags(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """Distinct reads of fusions that have no tags."""
    return rows.select("read_id").distinct().join(tags, "read_id", "left_anti")


def per_read(found: DataFrame) -> DataFrame:
    """of_cells() with n, the rows of its fusion name; ordered by that, most frequent first."""
    n = found.groupBy("FusionName").agg(F.count("*").alias("n"))
    return found.join(n, "FusionName").orderBy(F.desc("n"), "FusionName", "read_id")


def per_fusion(found: DataFrame, sample: str) -> DataFrame:
    """Cells and UMIs of every fusion; no row where no read has tags."""
    return found.groupBy(*KEYS).agg(F.countDistinct("CB").alias("cells"), F.countDistinct("UB").alias("UMIs")).withColumn("sample_ID", F.lit(sample)).withColumnRenamed("FusionName", "Fusion")


def per_sample(found: DataFrame, sample: str) -> DataFrame:
    """One row: cells with fusions, fusions, reads, and their means a cell; zeros where no read has tags."""
    cells = found.groupBy("CB").agg(F.count("*").alias("_n"), F.countDistinct("FusionName").alias("_f"))
    each = cells.agg(F.count("*").alias("cells_with_fusions"), F.coalesce(F.sum("_n"), F.lit(0)).alias("reads"), F.coalesce(F.avg("_n"), F.lit(0.0)).alias("mean_fusion_reads_per_cell"), F.coalesce(F.avg("_f"), F.lit(0.0)).alias("mean_unique_fusions_per_cell"))
    names = found.agg(F.countDistinct("FusionName").alias("unique_fusions"))
    return each.join(F.broadcast(names)).select(F.lit(sample).alias("sample_ID"), "cells_with_fusions", "unique_fusions", "reads", "mean_fusion_reads_per_cell", "mean_unique_fusions_per_cell")
