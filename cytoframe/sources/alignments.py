"""Alignments as SAM text: rows with a map of tags, and tagged rows back to text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import seq

#: Tag names of the columns that a tagged alignment carries.
TAG_COLUMNS = {"CR": "uncorrected_barcode", "CB": "corrected_barcode", "CY": "quality_barcode", "UR": "uncorrected_umi", "UB": "corrected_umi", "UY": "quality_umi", "GN": "gene", "TR": "transcript"}
UNMAPPED, SECONDARY, SUPPLEMENTARY = 4, 256, 2048


def parsed(lines: DataFrame, *, line: str = "value") -> DataFrame:
    """Alignment lines as rows: the other columns, then read_id, flag, chr, start (0-based), end (exclusive), mapq, cigar, seq, qual, tags."""
    field = F.split(line, "\t")
    tags = F.map_from_entries(F.transform(F.slice(field, 12, F.greatest(F.size(field) - 11, F.lit(0))), lambda x: F.struct(F.substring(x, 1, 2), F.substring(x, 6, 1 << 30))))
    start = field[3].cast("long") - 1
    other = [c for c in lines.columns if c != line]
    return lines.select(*other, field[0].alias("read_id"), field[1].cast("int").alias("flag"), field[2].alias("chr"), start.alias("start"), (start + seq.cigar_length(field[5], "MDN=X")).alias("end"), field[4].cast("int").alias("mapq"), field[5].alias("cigar"), field[9].alias("seq"), field[10].alias("qual"), tags.alias("tags"))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (read_id, flag, chr, start, end, mapq, cigar, seq, qual, tags), start 0-based and end exclusive; header lines are left out."""
    return parsed(spark.read.text(path).where("not value rlike '^@[A-Z][A-Z]\\t' and value != ''"))


def read_references(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (chr, length) of the headers' reference lines."""
    lines = spark.read.text(path).where("value like '@SQ\\t%'")
    return lines.select(F.regexp_extract("value", "\tSN:([^\t]+)", 1).alias("chr"), F.regexp_extract("value", "\tLN:([0-9]+)", 1).cast("long").alias("length")).distinct()


def without_flags(alignments: DataFrame, mask: int) -> DataFrame:
    """Alignments that carry none of the flags."""
    return alignments.where(F.col("flag").bitwiseAND(mask) == 0)


def transcript_alignments(alignments: DataFrame, references: DataFrame) -> DataFrame:
    """Scores of mapped alignments to transcripts: aln_score (0 where absent), tr_cov and q_cov (covered shares of transcript and read), tr_mapq."""
    c = F.col("cigar")
    mapped = alignments.where("chr != '*'").join(references, "chr")
    return mapped.select("read_id", F.col("chr").alias("query_transcript"), F.coalesce(F.try_element_at("tags", F.lit("AS")).cast("int"), F.lit(0)).alias("aln_score"), ((F.col("end") - F.col("start")) / F.col("length")).alias("tr_cov"), F.try_divide(seq.cigar_length(c, "MI=X"), seq.cigar_length(c, "MIS=XH")).alias("q_cov"), F.col("mapq").alias("tr_mapq"))


def extract_tags(alignments: DataFrame) -> DataFrame:
    """Tags of the records that have a corrected barcode; absent ones are '-', absent qualities eight question marks."""
    tag = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit("?" * 8 if k in ("CY", "UY") else "-")).alias(k)
    return alignments.where(F.map_contains_key("tags", F.lit("CB"))).select("read_id", *[tag(k) for k in TAG_COLUMNS], "chr", "start", "end", "mapq")


def flag_counts(alignments: DataFrame) -> DataFrame:
    """One row: primary, secondary, supplementary and unmapped alignments, and all."""
    has = lambda m: F.col("flag").bitwiseAND(m) > 0
    return alignments.agg(F.count_if(~has(UNMAPPED | SECONDARY | SUPPLEMENTARY)).alias("primary"), F.count_if(has(SECONDARY)).alias("secondary"), F.count_if(has(SUPPLEMENTARY)).alias("supplementary"), F.count_if(has(UNMAPPED)).alias("unmapped"), F.count("*").alias("total"))


def tag_alignments(alignments: DataFrame, tags: DataFrame) -> DataFrame:
    """Alignments with the tags of their read put into the map; reads without tags go. tags: read_id and columns named as TAG_COLUMNS' keys."""
    held = [k for k in TAG_COLUMNS if k in tags.columns]
    entries = F.map_filter(F.create_map(*[x for k in held for x in (F.lit(k), F.col(f"_{k}"))]), lambda _, v: v.isNotNull())
    own = tags.select("read_id", *[F.col(k).alias(f"_{k}") for k in held])
    kept = F.map_filter("tags", lambda k, _: ~k.isin(held))
    return alignments.join(own, "read_id").withColumn("tags", F.map_concat(kept, entries)).drop(*[f"_{k}" for k in held])


def write_sam(alignments: DataFrame, path: str, *, compression: str = "gzip") -> None:
    """SAM lines in coordinate order, ties by read_id, without header; integers are tagged i, the rest Z.

    Unmapped reads all have one place: read_id is part of the ranges, so that they do not fall to one task.
    """
    pairs = F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.when(e["value"].rlike("^-?[0-9]+$"), ":i:").otherwise(":Z:"), e["value"]))
    fields = F.concat_ws("\t", "read_id", "flag", "chr", (F.col("start") + 1).cast("string"), "mapq", "cigar", F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", pairs)
    alignments.repartitionByRange("chr", "start", "read_id").sortWithinPartitions("chr", "start", "read_id").select(fields.alias("value")).write.option("compression", compression).text(path)


def split_at_junctions(alignments: DataFrame) -> DataFrame:
    """Alignments cut at the N operations of their CIGAR: one row a block, with part (from 0), start, end, cigar and its bases.

    Each block keeps the operations between two junctions; clipped bases stay with the first and last block.
    """
    ops = F.transform(F.regexp_extract_all("cigar", F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1)), lambda o: F.struct(F.regexp_extract(o, "^[0-9]+", 0).cast("long").alias("n"), F.right(o, F.lit(1)).alias("k")))
    empty = F.struct(F.col("start").alias("at"), F.lit(1).cast("long").alias("base"), F.lit(0).alias("part"), F.array().cast("array<struct<part:int,start:bigint,end:bigint,op:string,from:bigint,bases:bigint>>").alias("out"))

    def step(s, o):
        ref = F.when(o["k"].isin("M", "D", "N", "=", "X"), o["n"]).otherwise(F.lit(0).cast("long"))
        read = F.when(o["k"].isin("M", "I", "S", "=", "X"), o["n"]).otherwise(F.lit(0).cast("long"))
        cut = o["k"] == "N"
        own = F.struct(s["part"].alias("part"), s["at"].alias("start"), (s["at"] + ref).alias("end"), F.concat(o["n"].cast("string"), o["k"]).alias("op"), s["base"].alias("from"), read.alias("bases"))
        return F.struct((s["at"] + ref).alias("at"), (s["base"] + read).alias("base"), F.when(cut, s["part"] + 1).otherwise(s["part"]).alias("part"), F.when(cut, s["out"]).otherwise(F.array_append(s["out"], own)).alias("out"))

    other = [c for c in alignments.columns if c not in ("start", "end", "cigar", "seq", "qual")]
    walked = alignments.withColumn("_w", F.aggregate(ops, empty, step)["out"])
    parts = walked.select("*", F.explode(F.transform(F.array_distinct(F.transform("_w", lambda x: x["part"])), lambda p: F.struct(p.alias("part"), F.filter("_w", lambda x: x["part"] == p).alias("ops")))).alias("_p"))
    total = F.aggregate("_p.ops", F.lit(0).cast("long"), lambda t, x: t + x["bases"])
    cut = lambda c: F.when(F.col(c) == "*", "*").otherwise(F.substring(F.col(c), F.col("_p.ops")[0]["from"].cast("int"), total.cast("int")))
    return parts.select(*other, F.col("_p.part").alias("part"), F.array_min(F.transform("_p.ops", lambda x: x["start"])).alias("start"), F.array_max(F.transform("_p.ops", lambda x: x["end"])).alias("end"), F.array_join(F.transform("_p.ops", lambda x: x["op"]), "").alias("cigar"), cut("seq").alias("seq"), cut("qual").alias("qual"))


def clip_depth(alignments: DataFrame, depths: DataFrame, target: float) -> DataFrame:
    """Alignments thinned where they are deep: reads (read_id, depth) stay with the chance target / depth, others all.

    Drawn from a hash of the read's id, so a task that runs again keeps the same reads.
    """
    draw = F.pmod(F.xxhash64("read_id", F.lit(1889)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    j = alignments.join(depths.select("read_id", F.col("depth").alias("_depth")), "read_id", "left")
    return j.where(F.col("_depth").isNull() | (draw <= target / F.col("_depth"))).drop("_depth")


def header_kinds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (file, references, aligned, sorted): each file's reference lines (name, length, checksum) in order, and what its header says."""
    lines = spark.read.text(path).where("value rlike '^@[A-Z][A-Z]\\t'").select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("_i"), "value")
    tag = lambda t: F.regexp_extract("value", f"\t{t}:([^\t]+)", 1)
    per = lines.groupBy("file").agg(F.array_sort(F.collect_list(F.when(F.col("value").startswith("@SQ"), F.struct("_i", F.concat_ws(":", tag("SN"), tag("LN"), tag("M5")).alias("sq"))))).alias("_r"), F.bool_or(F.col("value").startswith("@HD") & (tag("SO") == "coordinate")).alias("sorted"))
    return per.select("file", F.transform("_r", lambda x: x["sq"]).alias("references"), (F.size("_r") > 0).alias("aligned"), F.coalesce("sorted", F.lit(False)).alias("sorted"))


def same_references(kinds: DataFrame) -> bool:
    """Whether all files of header_kinds() name the same references in the same order."""
    return kinds.select("references").distinct().count() <= 1


def chromosomes(references: DataFrame) -> DataFrame:
    """Names of the references, and '*' for unmapped reads."""
    return references.select("chr").distinct().union(references.sparkSession.createDataFrame([("*",)], "chr string"))
