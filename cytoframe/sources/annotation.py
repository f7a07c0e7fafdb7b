"""Annotation, genotype and sample-sheet text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sample types that a sheet may name.
SAMPLE_TYPES = ("test_sample", "positive_control", "negative_control", "no_template_control")


def read_transcript_genes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (ref_id, gene_name) of the transcript lines of GTF text; either is null where its attribute is missing."""
    lines = spark.read.text(path).where("not startswith(value, '#')").where(F.lower(F.split("value", "\t")[2]).isin("transcript", "mrna"))
    named = lambda p, g: F.nullif(F.regexp_extract("value", p, g), F.lit(""))
    return lines.select(named('transcript_id "(.+?)"', 1).alias("ref_id"), named('(gene_name|genename) "(.+?)"', 2).alias("gene_name"))


def junctions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Introns (chr, start, end, transcript) between consecutive exons of GTF text, 0-based; one sorted list of exons a transcript."""
    f = F.split("value", "\t")
    exons = spark.read.text(path).where("not startswith(value, '#')").where(f[2] == "exon").select(f[0].alias("chr"), (f[3].cast("long") - 1).alias("_s"), f[4].cast("long").alias("_e"), F.regexp_extract("value", 'transcript_id "(.+?)"', 1).alias("transcript"))
    each = exons.groupBy("chr", "transcript").agg(F.array_sort(F.collect_list(F.struct("_s", "_e"))).alias("_x")).where(F.size("_x") > 1)
    gaps = F.explode(F.transform(F.sequence(F.lit(1), F.size("_x") - 1), lambda i: F.struct(F.get("_x", i - 1)["_e"].alias("start"), F.get("_x", i)["_s"].alias("end"))))
    return each.select("chr", gaps.alias("g"), "transcript").select("chr", "g.start", "g.end", "transcript")


def read_genotypes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (variant, chrom, pos, ref, alt, sample, gt) of VCF text, one a variant and sample; variant is chrom_pos_ref_alt with the first
    alternative. Each file's calls are named by its own header."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("_file"), "value")
    names = lines.where("startswith(value, '#CHROM\t')").select("_file", F.posexplode(F.slice(F.split("value", "\t"), 10, 1 << 30)).alias("_i", "sample"))
    f = F.split("value", "\t")
    rows = lines.where("not startswith(value, '#') and value != ''").select("_file", f[0].alias("chrom"), f[1].cast("long").alias("pos"), f[3].alias("ref"), f[4].alias("alt"), F.concat_ws("_", f[0], f[1], f[3], F.split(f[4], ",")[0]).alias("variant"), F.array_position(F.split(f[8], ":"), "GT").cast("int").alias("_gt"), F.slice(f, 10, 1 << 30).alias("_calls"))
    calls = rows.select("*", F.posexplode("_calls").alias("_i", "_call")).join(names, ["_file", "_i"])
    return calls.select("variant", "chrom", "pos", "ref", "alt", "sample", F.when(F.col("_gt") > 0, F.get(F.split("_call", ":"), F.col("_gt") - 1)).otherwise("./.").alias("gt"))


def read_names(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct names of a list, one a line without a header, such as genes of interest or variants to report; blank lines are left out."""
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", "\r$", "")).alias("name")).where("name != ''").distinct()


def read_coordinates(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows (cell, x, y) of a table of barcodes and their places, tab-separated without a header; a cell without two whole numbers is left out."""
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = spark.read.text(path).select(F.get(f, F.lit(0)).alias("cell"), F.get(f, F.lit(1)).try_cast("int").alias("x"), F.get(f, F.lit(2)).try_cast("int").alias("y"))
    return rows.where("x is not null and y is not null")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sample sheet from CSV text with a header, in UTF-8 or, where it begins with their mark, UTF-16; the mark goes."""
    raw = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 2).alias("_m")).first()
    utf16 = raw is not None and bytes(raw["_m"]) in (b"\xff\xfe", b"\xfe\xff")
    # a sheet is a list of samples: rows by the dozen
    table = spark.read.option("header", True).option("encoding", "UTF-16" if utf16 else "UTF-8").option("multiLine", utf16).csv(path)
    return table.select(*[F.trim(F.col(f"`{c}`")).alias(c.replace("\ufeff", "").strip()) for c in table.columns])


def group_counts(sheet: DataFrame) -> DataFrame:
    """Samples with n_group: how many the sheet has of their analysis group."""
    return sheet.join(sheet.groupBy("analysis_group").agg(F.count("*").alias("n_group")), "analysis_group")


def sheet_faults(sheet: DataFrame, *, required_types: tuple[str, ...] = ()) -> DataFrame:
    """Rows (fault) for every rule that a sample sheet breaks, from one aggregate; no row if it is sound."""
    missing = [c for c in ("barcode", "alias") if c not in sheet.columns]
    if missing:
        return sheet.sparkSession.createDataFrame([(f"no column {c}",) for c in missing], "fault string")
    b, a = F.col("barcode"), F.col("alias")
    rules = {
        "a barcode is not 'barcode' and two digits or more": F.count_if(~F.coalesce(b.rlike(r"^barcode\d\d+$"), F.lit(False))) > 0,
        "an alias begins with 'barcode'": F.count_if(a.startswith("barcode")) > 0,
        "barcodes differ in length": F.min(F.length(b)) < F.max(F.length(b)),
        "a barcode repeats": F.count("*") > F.countDistinct(b),
        "an alias repeats": F.count("*") > F.countDistinct(a),
    }
    if "type" in sheet.columns:
        rules["a sample type is unknown"] = F.count_if(~F.coalesce(F.col("type").isin(*SAMPLE_TYPES), F.lit(False))) > 0
        rules |= {f"no sample of type {k}": F.count_if(F.col("type") == k) < 1 for k in required_types}
    if "analysis_group" in sheet.columns:
        rules["a sample lacks its analysis group"] = F.count_if(F.coalesce(F.col("analysis_group"), F.lit("")) == "") > 0
    found = sheet.agg(*[F.when(rule, F.lit(text)).alias(f"_{i}") for i, (text, rule) in enumerate(rules.items())])
    return found.select(F.explode(F.array_compact(F.array(*found.columns))).alias("fault"))


def join_sheet(found: DataFrame, sheet: DataFrame) -> DataFrame:
    """Full outer join of discovered samples (folder) with a sheet, by barcode or else by alias; samples that the sheet lacks go.

    matched says which column agreed, or is null for a sheet row without a folder. Two folders of one row are an error, raised when the
    result is read.
    """
    on = F.col("folder").isin(F.col("barcode"), F.col("alias"))
    both = F.explode(F.array(F.struct(F.lit("barcode").alias("k"), F.col("barcode").alias("v")), F.struct(F.lit("alias").alias("k"), F.col("alias").alias("v"))))
    keys = sheet.select("*", both.alias("_x"))
    hit = keys.join(found, F.col("_x.v") == F.col("folder")).where(on).groupBy(*sheet.columns).agg(F.max("folder").alias("folder"), F.max("_x.k").alias("matched"), F.min("folder").alias("_other"))
    twice = F.raise_error(F.concat_ws(" ", F.lit("two folders match one row of the sheet:"), "folder", "_other"))
    hit = hit.withColumn("folder", F.when(F.col("folder") != F.col("_other"), twice).otherwise(F.col("folder"))).drop("_other")
    return hit.unionByName(sheet.join(hit.select("barcode"), "barcode", "left_anti"), allowMissingColumns=True)
