"""Barcode counting, knee selection and error-tolerant correction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators.ranks import numbered
from cytoframe.sources.scratch import parts_for, written

KMER = 5
STRINGS_A_TASK = 20_000  # strings whose deletion variants a task sorts, some hundred rows each
FULL_LIST = 500  # entries up to which a list is compared one by one; longer ones go through an index that gives the same pairs


def quantile_knee(counts: DataFrame, expected: int, quantile: float = 0.95, divisor: float = 20) -> DataFrame:
    """Barcodes with at least a twentieth of the 0.95 quantile of the `expected` largest counts."""
    top = counts.orderBy(F.desc("count"), "barcode").limit(expected)
    limit = top.agg((F.percentile("count", F.lit(quantile)) / divisor).alias("_limit"))
    return counts.join(F.broadcast(limit), F.col("count") >= F.col("_limit")).select("barcode", "count")


def fixed_knee(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent barcodes."""
    return counts.orderBy(F.desc("count"), "barcode").limit(n)


def thinned(counts: DataFrame, points: int) -> DataFrame:
    """Barcodes of a rank curve of about so many points: every n-th by count (down) and name, all where there are no more."""
    total = counts.count()
    if total <= points:
        return counts.select("barcode", "count")
    return numbered(counts, "_n", F.desc("count"), F.col("barcode")).where(F.col("_n") % (total // points) == 0).select("barcode", "count")


def abundance_knee(counts: DataFrame, least: int) -> DataFrame:
    return counts.where(F.col("count") >= least)


def distance_knee(counts: DataFrame) -> DataFrame:
    """Barcodes from the point of the ascending curve of counts on that lies farthest from the chord between its ends.

    The distance is linear along a run of equal counts, so only both ends of each run can be that point, and the histogram of the
    counts, whose size does not grow with the barcodes, holds them all. Of equal distances the first point counts. Where it is the last
    of its run, one barcode of that count stays: the first in byte order.
    """
    histogram = counts.groupBy("count").agg(F.count("*").alias("_n"), F.min("barcode").alias("_one"))
    last = F.sum("_n").over(Window.orderBy("count")) - 1
    ranked = histogram.select("count", "_one", last.alias("_b"), (last - F.col("_n") + 1).alias("_a"))
    ends = ranked.agg(F.min("count").alias("_y0"), F.max("count").alias("_y1"), F.max("_b").alias("_x1"))
    points = ranked.select("count", "_one", F.explode(F.array(F.struct(F.col("_a").alias("i"), F.lit(True).alias("whole")), F.struct(F.col("_b").alias("i"), (F.col("_a") == F.col("_b")).alias("whole")))).alias("_p")).join(F.broadcast(ends))
    gap = F.abs((F.col("_y1") - F.col("_y0")) * F.col("_p.i") - (F.col("count") - F.col("_y0")) * F.col("_x1"))
    best = points.agg(F.min(F.struct((-gap).alias("g"), F.col("_p.i").alias("i"), (~F.col("_p.whole")).alias("part"), F.col("count").alias("c"), F.col("_one").alias("one"))).alias("_k")).select(F.col("_k.c").alias("_c"), F.col("_k.one").alias("_one"), F.col("_k.part").alias("_part"))
    c = F.col("count")
    return counts.join(F.broadcast(best), (c > F.col("_c")) | ((c == F.col("_c")) & (~F.col("_part") | (F.col("barcode") == F.col("_one"))))).select("barcode", "count")


def _candidates(rest: DataFrame, listed: DataFrame, blocked: bool) -> DataFrame:
    """Pairs (cr, wl) to be compared, repeated ones included."""
    if not blocked:
        return rest.join(listed)
    left = rest.select("cr", F.explode(F.array_distinct(seq.kmers(F.col("cr"), KMER))).alias("_k"))
    right = listed.select("wl", F.explode(F.array_distinct(seq.kmers(F.col("wl"), KMER))).alias("_k"))
    return left.join(right, "_k").select("cr", "wl")


def _variants(df: DataFrame, c: str, edits: int) -> DataFrame:
    """Rows (c, _k): hashes of the strings that deleting up to `edits` characters of c gives, some of them twice.

    Deletions go from left to right, a step each; a step past the end deletes nothing. Of equal neighbours the first one goes. A string
    gives hundreds of rows, so strings are dealt out before, by a hash of their own: a table that is already dealt by the string may
    have been put together into a few tasks.
    """
    dealt = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(dealt, F.xxhash64(c)).select(c, F.col(c).alias("_x"), F.lit(1).alias("_from"))
    i, x = F.col("_i"), F.col("_x")
    for _ in range(edits):
        steps = rows.select(c, "_x", "_from", F.explode(F.sequence("_from", F.length(x) + 1)).alias("_i"))
        first = (i == F.col("_from")) | (F.substring(x, i, F.lit(1)) != F.substring(x, i - 1, F.lit(1)))
        rows = steps.where(first).select(c, F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))).alias("_x"), i.alias("_from"))
    return rows.select(c, F.xxhash64("_x").alias("_k"))


def within(rest: DataFrame, listed: DataFrame, edits: int, strings: int = 0) -> DataFrame:
    """Distinct pairs (cr, wl, ed) within so many edits: both sides meet where deleting up to `edits` bases gives them a string in common.

    No pair within the edits is lost. Equal hashes of other strings only cost a comparison. Neither side is broadcast however small it looks.
    With the number of `strings` of both sides, variants are dealt to more parts where there are many; of one string they are few, so none is hot.
    """
    parts = parts_for(rest.sparkSession, strings, STRINGS_A_TASK)
    usual = parts_for(rest.sparkSession, 0)
    left, right = (v.repartition(parts, "_k") if parts > usual else v for v in (_variants(rest, "cr", edits), _variants(listed, "wl", edits)))
    pairs = left.join(right.hint("merge"), "_k").select("cr", "wl").withColumn("ed", F.levenshtein("cr", "wl", edits))
    return pairs.where("ed >= 0").distinct()


def _indexed(rest: DataFrame, listed: DataFrame, max_edits: int, margin: int, blocked: bool) -> DataFrame:
    """Pairs (cr, wl, ed) that decide each barcode: all within max_edits, and where the best one needs a look beyond, the runners-up.

    A runner-up counts only if it is less than `margin` edits behind the best. So only barcodes whose one entry within max_edits is near
    that bound are sought again with more deletions. Blocked, pairs without a common k-mer do not count.
    """
    parts = lambda c: F.array_distinct(seq.kmers(F.col(c), KMER))
    met = lambda pairs: pairs.where(F.arrays_overlap(parts("cr"), parts("wl"))) if blocked else pairs
    strings = rest.count() + listed.count()
    near = written(met(within(rest, listed, max_edits, strings)), "near")
    reach = max_edits + margin - 1
    if reach <= max_edits:
        return near
    open_ = near.groupBy("cr").agg(F.min("ed").alias("_b"), F.count("*").alias("_n")).where((F.col("_n") == 1) & (F.col("_b") + margin - 1 > max_edits)).select("cr")
    return near.union(met(within(open_, listed, reach, strings))).distinct()


def correct(reads: DataFrame, whitelist: DataFrame, *, max_edits: int = 2, margin: int = 2, blocked: bool = True, barcode_length: int | None = None) -> DataFrame:
    """Distinct uncorrected barcodes (cr) with the assigned one (cb, null if none) and the reason.

    Exact barcodes are found by an equi-join first. Of the others, each distinct one is compared with the whitelist entries, `blocked`
    only with those that share a k-mer with it: a best entry within max_edits wins if the runner-up is `margin` edits farther. Up to
    FULL_LIST entries are compared one by one, or those that a k-mer leads to. K-mers of five bases are few, so in longer lists they lead
    to most entries: there an index of deletion variants finds the same best and runner-up, at a cost per barcode and per entry. Distances
    are taken inside the join, so only near pairs move; the two best of each barcode are picked before the exchange. With barcode_length,
    barcodes more than max_edits shorter are neither assigned nor given a reason.
    """
    listed = written(whitelist.select(F.col("barcode").alias("wl")).distinct(), "listed")
    split = written(reads.select("cr").distinct().join(listed.select(F.col("wl").alias("cr"), F.lit(True).alias("_exact")), "cr", "left"), "barcodes")
    exact, rest = split.where("_exact").select("cr"), split.where("_exact is null").select("cr")
    short = F.length("cr") < (barcode_length or max_edits) - max_edits
    limit = max_edits + margin + 1
    compared = lambda some: _candidates(some, listed, blocked).withColumn("ed", F.levenshtein("cr", "wl", limit)).where("ed >= 0")
    if listed.count() > FULL_LIST:
        near = _indexed(rest.where(~short), listed, max_edits, margin, blocked)
        if not blocked and (barcode_length or 0) < 2 * max_edits + margin:
            # the runner-up of a barcode this short counts at any distance; there are few such strings
            near = near.union(compared(rest.where(~short & (F.length("cr") < max_edits + margin)))).distinct()
    else:
        near = compared(rest.where(~short))
        near = near.distinct() if blocked else near
    place = F.row_number().over(Window.partitionBy("cr").orderBy("ed", "wl"))
    two = near.withColumn("_place", place).where("_place <= 2").groupBy("cr").agg(F.min(F.struct("ed", "wl")).alias("_b"), F.max(F.when(F.col("_place") == 2, F.col("ed"))).alias("_s"))
    decided = rest.join(two, "cr", "left")
    gap = F.coalesce("_s", F.length("cr")) - F.col("_b.ed")
    reason = F.when(short, None).when(F.col("_b").isNull() | (F.col("_b.ed") > max_edits), "bc_no_shortlist_match").when(gap >= margin, "bc_corrected").otherwise("bc_shortlist_multiple_hits")
    decided = decided.select("cr", F.when(reason == "bc_corrected", F.col("_b.wl")).alias("cb"), reason.alias("reason"))
    return exact.select("cr", F.col("cr").alias("cb"), F.lit("bc_shortlist_exact_match").alias("reason")).unionByName(decided)


def reason_counts(reads: DataFrame, corrected: DataFrame) -> DataFrame:
    """Reads by the reason that their barcode was given; barcodes without one are not counted."""
    return reads.join(corrected.where("reason is not null"), "cr").groupBy("reason").count()


def assigned_counts(reads: DataFrame, corrected: DataFrame) -> DataFrame:
    """Reads (cb, count) of every assigned barcode."""
    return reads.join(corrected.where("cb is not null"), "cr").groupBy("cb").count()
