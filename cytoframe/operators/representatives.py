"""One read for each molecule: reads of a cell with one corrected UMI that begin at the same place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REVERSE, UNMAPPED = 16, 4
MOLECULE = ("chr", "CB", "UB", "reverse", "five_prime")


def clipped(cigar: Column, *, at_end: bool) -> Column:
    """Soft-clipped bases at the beginning or end of a CIGAR, behind hard-clipped ones."""
    found = F.regexp_extract(cigar, "([0-9]+)S([0-9]+H)?$" if at_end else "^([0-9]+H)?([0-9]+)S", 1 if at_end else 2)
    return F.coalesce(F.nullif(found, F.lit("")).cast("long"), F.lit(0).cast("long"))


def five_prime(flag: Column, start: Column, end: Column, cigar: Column) -> Column:
    """Where a read's first base would lie: start less the clipped bases before it, or on the reverse strand end and those behind it."""
    return F.when(flag.bitwiseAND(REVERSE) > 0, end + clipped(cigar, at_end=True)).otherwise(start - clipped(cigar, at_end=False))


def placed(reads: DataFrame) -> DataFrame:
    """Mapped reads (read_id, flag, chr, start, end, mapq, cigar, tags) with cell and UMI, and: CB, UB, reverse, five_prime, spliced, n_places.

    n_places is the number of places that the read maps to by its NH tag, 1 without. Reads without cell or UMI, or with '-' or '', are left out.
    """
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    known = lambda c: F.coalesce(F.col(c), F.lit("-")).isin("-", "") == F.lit(False)
    mapped = reads.where((F.col("flag").bitwiseAND(UNMAPPED) == 0) & (F.col("chr") != "*"))
    named = mapped.withColumns({"CB": tag("CB"), "UB": tag("UB"), "reverse": F.col("flag").bitwiseAND(REVERSE) > 0, "spliced": F.contains("cigar", F.lit("N")), "n_places": F.coalesce(tag("NH").cast("int"), F.lit(1))})
    return named.where(known("CB") & known("UB")).withColumn("five_prime", five_prime(F.col("flag"), F.col("start"), F.col("end"), F.col("cigar")))


def representatives(reads: DataFrame, *, tell_spliced: bool = False, n_reads: str = "n_reads") -> DataFrame:
    """One read a molecule, all columns, with the number of reads that it stands for.

    Reads of one cell, UMI, chromosome, strand and five-prime place are one molecule; with tell_spliced, spliced reads are another one.
    The read that maps to the fewest places stays, then that of the best mapping quality, then the first by name and line. Best reads are
    kept before the only exchange, so a molecule of very many reads costs a task one row each.
    """
    rows = placed(reads)
    key = [*MOLECULE, "spliced"] if tell_spliced else list(MOLECULE)
    own = F.struct(*[F.col(c) for c in reads.columns])
    order = F.struct("n_places", -F.col("mapq"), "read_id", "flag", "start", "end", "cigar")
    best = rows.groupBy(*key).agg(F.min_by(own, order).alias("_best"), F.count("*").alias(n_reads))
    return best.select("_best.*", *[c for c in key if c not in reads.columns], n_reads)
