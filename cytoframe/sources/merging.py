"""Alignment files of many samples, of every kind, as one sorted table with one header a sample, or as reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.sources import alignments, headers, records
from cytoframe.sources.scratch import written

REVERSE, NO_READ = 16, alignments.SECONDARY | alignments.SUPPLEMENTARY


@dataclass
class Merged:
    """samples: sample, n_files, kind (unaligned, sorted, unsorted); headers: sample, rank, line; rows: sample and alignment columns.

    records: the rows in no order, for what needs none: they are read once and not exchanged.
    """

    samples: DataFrame
    headers: DataFrame
    rows: DataFrame
    references: DataFrame
    records: DataFrame


def file_kinds(lines: DataFrame) -> DataFrame:
    """Rows (sample, file, references, aligned, sorted) of every file: its references (name, length, checksum) in order, and its order."""
    tag = lambda t: F.regexp_extract("line", f"\t{t}:([^\t]+)", 1)
    is_head = F.col("line").rlike("^@[A-Z][A-Z]\t")
    reference = F.when(F.col("line").startswith("@SQ\t"), F.struct("at", F.concat_ws(":", tag("SN"), tag("LN"), tag("M5")).alias("sq")))
    ordered = F.col("line").startswith("@HD\t") & (tag("SO") == "coordinate")
    heads = lines.where(is_head).groupBy("sample", "file").agg(F.array_sort(F.collect_list(reference)).alias("_r"), F.bool_or(ordered).alias("sorted"))
    every = lines.select("sample", "file").distinct().join(heads, ["sample", "file"], "left")
    names = F.coalesce(F.transform("_r", lambda x: x["sq"]), F.array().cast("array<string>"))
    return every.select("sample", "file", names.alias("references"), (F.size(names) > 0).alias("aligned"), F.coalesce("sorted", F.lit(False)).alias("sorted"))


def sample_kinds(kinds: DataFrame) -> DataFrame:
    """Rows (sample, n_files, kind, mixed): unaligned without references; sorted if all of its files are; mixed if references differ."""
    kind = F.when(~F.bool_or("aligned"), "unaligned").when(F.bool_and("sorted"), "sorted").otherwise("unsorted")
    return kinds.groupBy("sample").agg(F.count("*").alias("n_files"), kind.alias("kind"), (F.min("references") != F.max("references")).alias("mixed"))


def merge_alignments(spark: SparkSession, path: str, *, by: str = "coordinate", keep_unaligned: bool = True, split_bytes: int = records.SPLIT_BYTES) -> Merged:
    """All SAM files of a folder, or of its sub-folders as samples ('' for files in the folder itself), as sorted rows.

    by coordinate: in the order of the header's references, then position; unmapped records last, and ties by name and flag. by name: by
    read_id and flag. One range exchange whatever the files' kinds and number: order is of no use to it, so files that are sorted already
    take the same way. Files of one sample with different references are an error. Unaligned samples stay, unless not wanted.
    """
    if by not in ("coordinate", "name"):
        raise ValueError("by must be coordinate or name")
    records.register(spark)
    lines = spark.read.format("sam_lines").option("split_bytes", split_bytes).load(path).withColumn("sample", F.coalesce("folder", F.lit(""))).drop("folder")
    # header lines stand before all others: a small part of what is read
    heads = written(lines.where("line rlike '^@[A-Z][A-Z](\\t|$)'").union(lines.groupBy("sample", "file").agg(F.lit(-1).cast("long").alias("at"), F.lit("").alias("line")).select("file", "at", "line", "sample")), "heads")
    kinds = written(file_kinds(heads), "kinds")
    samples = sample_kinds(kinds)
    if mixed := [r["sample"] for r in samples.where("mixed").select("sample").limit(20).collect()]:
        raise ValueError(f"files with different references in one sample: {', '.join(mixed)}")
    samples = samples.drop("mixed")
    if not keep_unaligned:
        samples = samples.where("kind != 'unaligned'")
    references = kinds.groupBy("sample").agg(F.max("references").alias("_r")).select("sample", F.posexplode("_r").alias("chr_rank", "_x")).select("sample", "chr_rank", F.regexp_extract("_x", "^(.*?):[0-9]+(:|$)", 1).alias("chr"))
    rows = alignments.parsed(lines.where("not line rlike '^@[A-Z][A-Z](\\t|$)'").select("sample", "line"), line="line")
    rows = loose = rows.join(samples.select("sample"), "sample", "left_semi")
    if by == "name":
        order = [F.col("sample"), F.col("read_id"), F.col("flag"), F.col("chr"), F.col("start")]
    else:
        rows = rows.join(references, ["sample", "chr"], "left")
        order = [F.col("sample"), F.col("chr_rank").asc_nulls_last(), F.col("start"), F.col("read_id"), F.col("flag")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return Merged(samples, headers.merged_headers(heads, sort_order="coordinate" if by == "coordinate" else "queryname").join(samples.select("sample"), "sample", "left_semi"), rows.drop("chr_rank"), references, loose)


def reads_of(rows: DataFrame) -> DataFrame:
    """Reads (sample, read_id, seq, qual, tags) of alignments: one a primary record, bases and qualities turned back as they were sequenced."""
    back = F.col("flag").bitwiseAND(REVERSE) > 0
    turn = lambda c, f: F.when(back & (F.col(c) != "*"), f(F.col(c))).otherwise(F.col(c)).alias(c)
    return alignments.without_flags(rows, NO_READ).select("sample", "read_id", turn("seq", seq.reverse_complement), turn("qual", F.reverse), "tags")


def contigs_with_reads(rows: DataFrame) -> DataFrame:
    """Rows (sample, chr, mapped): references with mapped records, and how many."""
    return alignments.without_flags(rows, alignments.UNMAPPED).where("chr != '*'").groupBy("sample", "chr").agg(F.count("*").alias("mapped"))
