"""Column functions over sequences and qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(s: Column) -> Column:
    """Reverse complement; case is kept, other letters than ACGT stay."""
    return F.translate(F.reverse(s), "ACGTacgt", "TGCAtgca")


def phred_min(q: Column) -> Column:
    """Smallest Phred+33 value of a quality string."""
    return F.array_min(F.transform(F.split(q, ""), lambda c: F.ascii(c) - 33))


def mean_quality(q: Column) -> Column:
    """Phred value of the mean error probability of a quality string (Phred+33); null without bases."""
    wrong = F.aggregate(F.split(q, ""), F.lit(0.0), lambda s, c: s + F.pow(F.lit(10.0), (F.lit(33) - F.ascii(c)) / 10))
    return F.when(F.length(q) > 0, -10 * F.log10(wrong / F.length(q)))


def subsequence(s: Column, start: Column, end: Column) -> Column:
    """Characters start (0-based) to end (exclusive)."""
    return F.substring(s, start + 1, end - start)


def kmers(s: Column, k: int, *, last: bool = False) -> Column:
    """All k-mers in order; the last one is left out unless `last` (the index of barcode correction is built without it)."""
    n = F.length(s) - k - (0 if last else 1)
    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), lambda i: F.substring(s, i + 1, F.lit(k)))).otherwise(F.array().cast("array<string>"))


def region_label(chrom: Column, start: Column, end: Column, width: int = 1000) -> Column:
    """chrom_floor_ceil of the middle of an alignment, in steps of `width`."""
    mid = F.floor((start + end) / 2)
    return F.concat_ws("_", chrom, (F.floor(mid / width) * width).cast("long"), (F.ceil(mid / width) * width).cast("long"))


def within_edits(a: Column, b: Column, limit: int) -> Column:
    """Edit distance, or null above the limit."""
    d = F.levenshtein(a, b, limit)
    return F.when(d >= 0, d)


def deletions(s: Column, n: int) -> Column:
    """All distinct strings that deleting up to n characters of s gives, s among them. Two strings within n edits share one of them."""
    one = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    out = now = F.array(s)
    for _ in range(n):
        now = F.array_distinct(F.flatten(F.transform(F.filter(now, lambda x: x != ""), one)))
        out = F.concat(out, now)
    return F.array_distinct(out)


def reverse_config(c: Column) -> Column:
    """An adapter configuration seen from the other strand: parts reversed, _f and _r swapped."""
    return F.array_join(F.transform(F.reverse(F.split(c, "-")), lambda x: F.when(x.endswith("_f"), F.regexp_replace(x, "_f$", "_r")).otherwise(F.regexp_replace(x, "_r$", "_f"))), "-")


def cigar_length(cigar: Column, operations: str) -> Column:
    """Summed lengths of the given CIGAR operations."""
    found = F.regexp_extract_all(cigar, F.lit(f"(\\d+)[{operations}]"), F.lit(1))
    return F.aggregate(found, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))


def genotype(gt: Column) -> Column:
    """Sum of the alleles of a genotype, -1 where one is missing."""
    parts = F.split(gt, "[/|]")
    return F.when(F.array_contains(parts, "."), F.lit(-1)).otherwise(F.aggregate(parts, F.lit(0), lambda s, x: s + x.cast("int")))


def number_text(value: Column, *, decimals: int = 0, unit: str = "") -> Column:
    """A number as a report shows it: thousands apart, so many decimals, and its unit; 'n/a' where it is missing."""
    shown = F.format_number(value, decimals)
    return F.coalesce(F.concat(shown, F.lit(f" {unit}")) if unit else shown, F.lit("n/a"))
