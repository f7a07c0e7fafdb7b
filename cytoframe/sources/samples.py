"""From a folder of reads, with or without a sample sheet, to reads with their sample and statistics of every sample, in one call."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.operators import readstats, summaries
from cytoframe.sources import annotation, records
from cytoframe.sources.ingress import FASTQ, alias


@dataclass
class Samples:
    """reads: alias, barcode, read_id, seq, qual, comment, read_length, mean_quality. samples: a row a sample, with its statistics."""

    reads: DataFrame
    samples: DataFrame


def sample_table(spark: SparkSession, folder: str, sheet: DataFrame | None = None, *, sample: str | None = None, unclassified: bool = False) -> DataFrame:
    """Rows (alias, barcode, folder, and the sheet's other columns): which sub-folder holds which sample.

    With a sheet (barcode, alias, ...): its rows, folder null where none is named by their barcode or alias; sub-folders that it lacks
    are left out; a barcode's and an alias's folder for one row are an error. Its faults are errors. Without: every sub-folder by its own
    name, or for files in the folder itself one row without folder, named `sample` or as the folder. `sample` keeps the one of that
    barcode or alias. A run has samples by the dozen, so this small table is made on the driver.
    """
    if sheet is not None and (faults := [r.fault for r in annotation.sheet_faults(sheet).collect()]):
        raise ValueError("; ".join(faults))
    files = records.listed(folder, FASTQ, unclassified=unclassified)
    names = sorted({f.folder for f in files if f.folder is not None})
    if sheet is None:
        if names:
            rows = [(n.replace(" ", "_"), n, n) for n in names if sample in (None, n)]
        else:
            rows = [(sample or folder.rstrip("/").rsplit("/", 1)[-1], None, None)] if files else []
        return spark.createDataFrame(rows, "alias string, barcode string, folder string")
    if files and not names:
        raise ValueError("input files lie in the folder itself although there is a sample sheet")
    found = annotation.join_sheet(spark.createDataFrame([(n,) for n in names], "folder string"), sheet).drop("matched")
    found = found.withColumn("alias", alias(F.col("alias")))
    return found if sample is None else found.where(F.col("alias").eqNullSafe(sample) | F.col("barcode").eqNullSafe(sample))


def fastq_ingress(spark: SparkSession, folder: str, sheet: DataFrame | None = None, *, sample: str | None = None, unclassified: bool = False, min_quality: float | None = None, min_length: int = 0, max_length: int | None = None, many_basecallers: bool = True, split_bytes: int = records.SPLIT_BYTES) -> Samples:
    """Reads of all samples of a folder with per-sample statistics of the reads that pass the bounds.

    Samples of the sheet without a folder, and those without a passing read, have n_seqs 0. Unless many_basecallers, samples whose reads
    come from several basecallers give no reads (their row stays). One scan per action; nothing is cached or written.
    """
    table = sample_table(spark, folder, sheet, sample=sample, unclassified=unclassified)
    options = {"split_bytes": str(split_bytes), "unclassified": str(unclassified).lower()}
    inside = [r.folder for r in table.where("folder is not null").select("folder").collect()]
    if inside:
        options["sheet"] = json.dumps({f: True for f in inside})
    rows = records.fastq(spark, folder, **options)
    key = table.select("alias", "barcode", F.col("folder").alias("_folder"))
    # eqNullSafe: files in the folder itself have no folder, and so has their one sample
    named = rows.join(key if inside else key.limit(1), F.col("folder").eqNullSafe(F.col("_folder"))).drop("_folder", "folder", "file")
    if not inside and sheet is not None:
        named = named.where("false")
    reads = readstats.passing(readstats.measured(named), min_quality=min_quality, min_length=min_length, max_length=max_length)
    info = summaries.run_info(reads.select(F.col("alias").alias("sample"), "comment")).drop("n_seqs").withColumnRenamed("sample", "alias")
    if not many_basecallers:
        good = summaries.one_basecaller(info).select("alias")
        reads = reads.join(good, "alias", "left_semi")
    stats = readstats.statistics(reads, "alias")
    samples = table.join(stats, "alias", "left").join(info, "alias", "left").na.fill(0, subset=["n_seqs", "n_bases"])
    return Samples(reads.select("alias", "barcode", "read_id", "seq", "qual", "comment", "read_length", "mean_quality"), samples)
