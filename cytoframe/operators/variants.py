"""Variant sites and genotypes: split, atomise, merge, tag and lay out as matrices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators.ranks import numbered

#: Names of the genotype codes.
GENOTYPES = {-1: "no_data", 0: "hom-ref", 1: "het", 2: "hom-alt"}
ROWS_REPORTED = 50


def biallelic(sites: DataFrame) -> DataFrame:
    """Sites (chrom, pos, ref, alt, ...) with one alternative a row; alt may list several, separated by commas."""
    return sites.withColumn("alt", F.explode(F.split("alt", ",")))


def atomized(sites: DataFrame) -> DataFrame:
    """Biallelic sites as substitutions of one base, and one insertion or deletion behind the last base that both alleles hold."""
    n = F.least(F.length("ref"), F.length("alt"))
    at = lambda c, i: F.substring(F.col(c), i, F.lit(1))
    bases = F.filter(F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((F.col("pos") + i - 1).alias("pos"), at("ref", i).alias("ref"), at("alt", i).alias("alt"))), lambda x: x["ref"] != x["alt"])
    anchor = at("ref", n)
    rest = F.when(F.length("ref") != F.length("alt"), F.array(F.struct((F.col("pos") + n - 1).alias("pos"), F.concat(anchor, F.substring(F.col("ref"), n + 1, F.length("ref"))).alias("ref"), F.concat(anchor, F.substring(F.col("alt"), n + 1, F.length("alt"))).alias("alt"))))
    more = F.concat(bases, F.coalesce(rest, F.filter(bases, lambda x: F.lit(False))))
    other = [c for c in sites.columns if c not in ("pos", "ref", "alt")]
    return sites.select(*other, F.explode(more).alias("_x")).select(*other, "_x.*")


def merged_sites(*tables: DataFrame) -> DataFrame:
    """Distinct atomised biallelic sites (chrom, pos, ref, alt) of several tables."""
    every = reduce(DataFrame.unionByName, [t.select("chrom", "pos", "ref", "alt") for t in tables])
    return atomized(biallelic(every)).distinct()


def label(code: Column) -> Column:
    """Name of a genotype code."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in GENOTYPES.items() for x in kv]), code)


def coded(calls: DataFrame) -> DataFrame:
    """Calls (chrom, pos, variant, sample, gt) with code: the sum of the alleles, -1 where one is missing."""
    return calls.withColumn("code", seq.genotype(F.col("gt")))


def fill_tags(calls: DataFrame) -> DataFrame:
    """Per variant: alternative alleles (ac), called alleles (an) and their ratio (af, null without calls)."""
    c = F.col("code")
    a = calls.groupBy("variant").agg(F.sum(F.when(c >= 0, c).otherwise(0)).alias("ac"), (2 * F.count_if(c >= 0)).alias("an"))
    return a.select("variant", "ac", "an", F.try_divide("ac", "an").alias("af"))


def chromosome_order(chrom: Column, chromosomes: list[str]) -> Column:
    """Place of a chromosome in the header's order; others come last."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(chromosomes) for x in (c, i)]), chrom), F.lit(len(chromosomes)))


def genotype_triples(calls: DataFrame, chromosomes: list[str], samples: list[str]) -> DataFrame:
    """1-based (row, col, value): variants in file order (chromosome, position, name), samples in header order; missing calls are left out."""
    sites = calls.select("chrom", "pos", "variant").distinct()
    rows = numbered(sites.withColumn("_c", chromosome_order(F.col("chrom"), chromosomes)), "row", "_c", "pos", "variant").select("variant", "row")
    col = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(samples) for x in (c, i + 1)]), F.col("sample")).cast("long")
    return calls.where("code >= 0").join(rows, "variant").select("row", col.alias("col"), F.col("code").alias("value"))


def report_table(calls: DataFrame, chromosomes: list[str], samples: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """Wide table of the first 50 variants (of those wanted) in file order: a column a sample, -1 where there is no call."""
    own = calls if wanted is None else calls.join(wanted, "variant", "left_semi")
    top = own.select("chrom", "pos", "variant").distinct().orderBy(chromosome_order(F.col("chrom"), chromosomes), "pos", "variant").limit(ROWS_REPORTED).select("variant")
    return own.join(F.broadcast(top), "variant", "left_semi").groupBy("variant").pivot("sample", samples).agg(F.max("code")).na.fill(-1)


def write_genotype_exchange(spark: SparkSession, calls: DataFrame, path: str, chromosomes: list[str], samples: list[str]) -> None:
    """Market-exchange folder of the genotype codes: matrix.mtx (header, entries), features.tsv and barcodes.tsv, each compressed parts."""
    gz = lambda df, name: df.write.option("compression", "gzip").text(f"{path}/{name}")
    triples = genotype_triples(calls, chromosomes, samples)
    order = chromosome_order(F.col("chrom"), chromosomes)
    sites = calls.select("chrom", "pos", "variant").distinct()
    gz(sites.repartitionByRange(order, "pos", "variant").sortWithinPartitions(order, "pos", "variant").select("variant"), "features.tsv")
    gz(spark.createDataFrame([(s,) for s in samples], "value string").coalesce(1), "barcodes.tsv")
    gz(triples.select(F.concat_ws(" ", "row", "col", "value").alias("value")), "matrix.mtx/entries")
    head = ["%%MatrixMarket matrix coordinate integer general", f"{sites.count()} {len(samples)} {triples.count()}"]
    gz(spark.createDataFrame([("\n".join(head),)], "value string"), "matrix.mtx/header")
