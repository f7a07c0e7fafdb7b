"""Genotypes of several files put together: one list of alleles a site, then one alternative a row, cut into single bases.

Calls stay rows of one sample each, and a sample without a call at a site has no row, so size follows the calls and not samples by sites.
What is known of a site (its alleles) is aggregated before it meets the calls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SITE = ("chrom", "pos")


def site_alleles(calls: DataFrame) -> DataFrame:
    """Rows (chrom, pos, ref, alts): each site's reference, the longest of its records', and the alternatives of all as seen from it.

    A shorter reference must be how a longer one begins, else an error when the row is read; its alternatives are lengthened by what it
    lacks. Alternatives stand in the order of their text.
    """
    records = calls.select(*SITE, "ref", "alt").distinct()
    longest = records.groupBy(*SITE).agg(F.max_by("ref", F.struct(F.length("ref"), "ref")).alias("_ref"))
    every = records.join(longest, list(SITE))
    fits = F.when(F.startswith("_ref", F.col("ref")), F.col("_ref")).otherwise(F.raise_error(F.concat_ws(" ", F.lit("references of one site differ:"), *SITE, "ref", "_ref")))
    grown = F.transform(alternatives("alt"), lambda a: F.concat(a, F.substring("_ref", F.length("ref") + 1, F.length("_ref"))))
    each = every.select(*SITE, fits.alias("_whole"), grown.alias("_g")).select(*SITE, "_whole", F.explode_outer("_g").alias("_a"))
    return each.groupBy(*SITE).agg(F.max("_whole").alias("ref"), F.array_sort(F.collect_set("_a")).alias("alts"))


def alternatives(alt: str) -> Column:
    """The alternatives of a record as an array; '.' is none."""
    return F.filter(F.split(alt, ","), lambda a: (a != ".") & (a != ""))


def alleles(gt: str) -> Column:
    """The alleles of a genotype as numbers, null where one is missing."""
    return F.transform(F.split(gt, "[/|]"), lambda a: F.when(a != ".", a.cast("int")))


def joined_calls(calls: DataFrame) -> DataFrame:
    """Calls (chrom, pos, ref, alt, sample, gt) of several files with alleles numbered by the site's joint list.

    Rows (chrom, pos, ref, alts, sample, own, phased): own holds the alleles' numbers, 0 for the reference, null where missing. Alleles
    beyond a record's own list are an error.
    """
    j = calls.select(*SITE, F.col("ref").alias("_ref"), "alt", "sample", "gt").join(site_alleles(calls), list(SITE))
    tail = F.substring("ref", F.length("_ref") + 1, F.length("ref"))
    named = lambda a: F.get(alternatives("alt"), a - 1)
    beyond = F.raise_error(F.concat_ws(" ", F.lit("a genotype names an allele that its record lacks:"), *SITE, "sample", "gt"))
    number = lambda a: F.when(a.isNull() | (a == 0), a).when(named(a).isNull(), beyond.cast("int")).otherwise(F.array_position("alts", F.concat(named(a), tail)).cast("int"))
    return j.select(*SITE, "ref", "alts", "sample", F.transform(alleles("gt"), number).alias("own"), F.contains("gt", F.lit("|")).alias("phased"))


def atoms(pos: Column, ref: Column, alt: Column) -> Column:
    """An alternative as an array of (pos, ref, alt): substitutions of one base, and one insertion or deletion behind the last base that both alleles hold."""
    n = F.least(F.length(ref), F.length(alt))
    at = lambda c, i: F.substring(c, i, F.lit(1))
    bases = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct((pos + i - 1).alias("pos"), at(ref, i).alias("ref"), at(alt, i).alias("alt")))
    bases = F.filter(bases, lambda x: x["ref"] != x["alt"])
    anchor = at(ref, n)
    rest = F.array(F.struct((pos + n - 1).alias("pos"), F.concat(anchor, F.substring(ref, n + 1, F.length(ref))).alias("ref"), F.concat(anchor, F.substring(alt, n + 1, F.length(alt))).alias("alt")))
    return F.when(F.length(ref) != F.length(alt), F.concat(bases, rest)).otherwise(bases)


def split_calls(joined: DataFrame) -> DataFrame:
    """Rows (chrom, pos, ref, alt, sample, gt, code): one single-base alternative each, with every sample's genotype of it.

    An allele is 1 where it holds the change, 0 where it is called and does not, '.' where it is missing. Changes that several records or
    alternatives give are one row: an allele holds it if it does in one of them. code is the number of alleles that hold it, null where
    an allele is missing.
    """
    sites = joined.select(*SITE, "ref", "alts").distinct()
    each = sites.select(*SITE, F.posexplode("alts").alias("_i", "_alt"), "ref")
    cut = each.select(*SITE, (F.col("_i") + 1).alias("_i"), F.explode(atoms(F.col("pos").cast("long"), F.col("ref"), F.col("_alt"))).alias("_x"))
    per = cut.groupBy(*SITE, "_x").agg(F.collect_set("_i").alias("_in"))
    rows = joined.select(*SITE, "sample", "own", "phased").join(per, list(SITE))
    holds = F.transform("own", lambda a: F.when(a.isNotNull(), F.array_contains("_in", a).cast("int")))
    rows = rows.select("chrom", "_x.pos", "_x.ref", "_x.alt", "sample", holds.alias("_h"), "phased")
    place = rows.select("chrom", "pos", "ref", "alt", "sample", "phased", F.posexplode("_h").alias("_k", "_v"))
    one = place.groupBy("chrom", "pos", "ref", "alt", "sample", "_k").agg(F.max("_v").alias("_v"), F.bool_and("phased").alias("_p"))
    back = one.groupBy("chrom", "pos", "ref", "alt", "sample").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "_v"))), lambda x: x["_v"]).alias("_h"), F.bool_and("_p").alias("_p"))
    text = F.array_join(F.transform("_h", lambda v: F.coalesce(v.cast("string"), F.lit("."))), "/")
    code = F.aggregate("_h", F.lit(0), lambda s, v: s + v)  # null with a missing allele
    return back.select("chrom", "pos", "ref", "alt", "sample", F.when(F.col("_p"), F.translate(text, "/", "|")).otherwise(text).alias("gt"), code.alias("code"))


def allele_counts(split: DataFrame) -> DataFrame:
    """Rows (chrom, pos, ref, alt, ac, an, af, ns): alleles that hold the change, called alleles, their ratio, and samples with a call."""
    each = F.split("gt", "[/|]")
    called = F.size(F.filter(each, lambda a: a != "."))
    a = split.groupBy("chrom", "pos", "ref", "alt").agg(F.sum(F.size(F.filter(each, lambda a: a == "1"))).alias("ac"), F.sum(called).alias("an"), F.count_if(called > 0).alias("ns"))
    return a.select("chrom", "pos", "ref", "alt", "ac", "an", F.try_divide("ac", "an").alias("af"), "ns")


def merged_genotypes(*tables: DataFrame) -> DataFrame:
    """split_calls() of the calls of several files: merged, cut into single bases and split by alternative, with their genotypes."""
    every = reduce(DataFrame.unionByName, [t.select("chrom", "pos", "ref", "alt", "sample", "gt") for t in tables])
    return split_calls(joined_calls(every))
