"""Interval joins, merges and depth. Intervals are half-open; overlaps meet in bins of several widths, so they are equi-joins.

An interval lies on the level whose bins are the narrowest that are no shorter than it, so it touches two of them at most. Two intervals
meet on the level of the longer one: there the longer stands in its own bins, and the shorter, which also touches two at most, looks
them up. No interval gives more than a few rows, whatever its length, and no pair is compared but those within a bin of the longer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.sources.scratch import written

#: Widths of the levels' bins, eight times as wide from one to the next; the last level takes all that is longer too, with more bins.
WIDTHS = tuple(1024 * 8**i for i in range(10))


def level(start: str = "start", end: str = "end") -> Column:
    """The level of an interval: a number below len(WIDTHS)."""
    out = F.lit(len(WIDTHS) - 1)
    for i in range(len(WIDTHS) - 2, -1, -1):
        out = F.when(F.col(end) - F.col(start) <= WIDTHS[i], i).otherwise(out)
    return out


def _bins(level: Column, start: Column, end: Column) -> Column:
    """The bins of a level that the interval touches; an empty one touches that of its start."""
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in WIDTHS]), level + 1)
    return F.sequence(F.floor(start / width), F.floor(F.greatest(end - 1, start) / width))


def _own(df: DataFrame) -> DataFrame:
    """Rows with their level and each of their own bins."""
    return df.withColumn("_level", level()).withColumn("_bin", F.explode(_bins(F.col("_level"), F.col("start"), F.col("end"))))


def _looked_up(df: DataFrame, levels: list[int], *, above: bool) -> DataFrame:
    """Rows with each bin that they touch on the given levels from their own on, or only on those above it."""
    own = level()
    some = F.filter(F.array(*[F.lit(x) for x in levels]), lambda x: (x > own) if above else (x >= own))
    each = df.withColumn("_level", F.explode(some))
    return each.withColumn("_bin", F.explode(_bins(F.col("_level"), F.col("start"), F.col("end"))))


def _levels(df: DataFrame) -> list[int]:
    """The levels that occur: ten numbers at most."""
    return sorted(r[0] for r in df.select(level().alias("_l")).distinct().collect())


def overlaps(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a (chrom, start, end, ...) with b's interval (start2, end2, ...) for each overlap, once: in the bin where it begins.

    Reads the intervals of either side once before to see which levels occur.
    """
    as_second = lambda df: df.withColumnsRenamed({"start": "start2", "end": "end2"})
    long_b = _looked_up(a, _levels(b), above=False).join(as_second(_own(b)), ["chrom", "_level", "_bin"])
    long_a = _own(a).join(as_second(_looked_up(b, _levels(a), above=True)), ["chrom", "_level", "_bin"])
    both = long_b.unionByName(long_a).where("start < end2 and start2 < end")
    width = F.element_at(F.array(*[F.lit(w).cast("long") for w in WIDTHS]), F.col("_level") + 1)
    return both.where(F.floor(F.greatest("start", "start2") / width) == F.col("_bin")).drop("_bin", "_level")


def _carried(places: DataFrame, stretch: int) -> DataFrame:
    """Places (chrom, at, starts, ends, first), one row each, with what their chromosome holds up to and from there.

    _begun: sum of `starts` at smaller places; _ended: sum of `ends` up to and at this one; _first: least `first` of greater ones.
    Chromosomes are swept in stretches of `stretch` places, each its own task, as in _swept().
    """
    p = places.withColumn("_s", F.floor(F.col("at") / stretch))
    order = Window.partitionBy("chrom").orderBy("_s")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    each = p.groupBy("chrom", "_s").agg(F.sum("starts").alias("_b"), F.sum("ends").alias("_e"), F.min("first").alias("_f"))
    carried = each.select("chrom", "_s", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_b"), F.coalesce(F.sum("_e").over(before), F.lit(0)).alias("_e"), F.min("_f").over(after).alias("_f"))
    w = Window.partitionBy("chrom", "_s").orderBy("at")
    back = Window.partitionBy("chrom", "_s").orderBy(F.desc("at"))
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    run = p.join(carried, ["chrom", "_s"])
    return run.select(
        "chrom", "at",
        (F.col("_b") + F.coalesce(F.sum("starts").over(past), F.lit(0))).alias("_begun"),
        (F.col("_e") + F.sum("ends").over(w.rowsBetween(Window.unboundedPreceding, 0))).alias("_ended"),
        F.least(F.min("first").over(back.rowsBetween(Window.unboundedPreceding, -1)), F.col("_f")).alias("_first"),
    )


def _places(a: DataFrame, b: DataFrame, *looked_up: str) -> DataFrame:
    """Rows (chrom, at, starts, ends, first): b's starts and ends at each place, the least start of what ends there, and the places of a."""
    none = F.lit(None).cast(b.schema["start"].dataType)
    row = lambda at, starts, ends, first: F.struct(at.alias("at"), F.lit(starts).cast("long").alias("starts"), F.lit(ends).cast("long").alias("ends"), first.alias("first"))
    own = b.where("start is not null and end is not null").select("chrom", F.explode(F.array(row(F.col("start"), 1, 0, none), row(F.col("end"), 0, 1, F.col("start")))).alias("x"))
    asked = a.select("chrom", F.explode(F.array(*[row(F.col(c), 0, 0, none) for c in looked_up])).alias("x"))
    both = own.union(asked).select("chrom", "x.*").where("chrom is not null and at is not null")
    return both.groupBy("chrom", "at").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.min("first").alias("first"))


def with_first_overlap(a: DataFrame, b: DataFrame, stretch: int = 1_000_000) -> DataFrame:
    """Rows of a that overlap any of b, with start2: the least start of b's intervals that do.

    No pair is formed: of b's intervals that end behind a row's start, the one that starts first overlaps it if any does. The work is
    that of sorting the distinct places, however many intervals overlap there.
    """
    found = _carried(_places(a, b, "start"), stretch).where("_first is not null").select("chrom", F.col("at").alias("start"), F.col("_first").alias("start2"))
    return a.join(found, ["chrom", "start"]).where("start2 < end").select(*a.columns, "start2")


def overlap_counts(a: DataFrame, b: DataFrame, stretch: int = 1_000_000) -> DataFrame:
    """Rows of a that overlap any of b, with n, the number of b's intervals that do, and start2, the first start of these.

    No pair is formed: n is the number of b's starts before a row's end less that of b's ends up to its start. An interval of no length
    counts where it lies inside another; one at the start of an empty row was neither begun before nor is it met.
    """
    places = written(_carried(_places(a, b, "start", "end"), stretch), "places")
    empty = b.where("start = end").groupBy("chrom", "start").agg(F.count("*").alias("_empty"))
    at = places.select("chrom", F.col("at").alias("start"), "_ended", F.col("_first").alias("start2")).join(empty, ["chrom", "start"], "left")
    met = a.join(at, ["chrom", "start"]).join(places.select("chrom", F.col("at").alias("end"), "_begun"), ["chrom", "end"])
    n = F.col("_begun") - F.col("_ended") + F.when(F.col("start") == F.col("end"), F.coalesce("_empty", F.lit(0))).otherwise(0)
    return met.where("start2 < end").select(*a.columns, n.alias("n"), "start2")


def overlapping(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that overlap any of b."""
    return with_first_overlap(a, b).select(*a.columns).distinct()


def first_overlap(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Rows (key, start2): the first start of b's intervals that overlap an interval of a."""
    return with_first_overlap(a, b).groupBy(*key).agg(F.min("start2").alias("start2"))


def widened(df: DataFrame, slop: int, lengths: DataFrame | None = None) -> DataFrame:
    """Intervals longer by `slop` on both sides, not beyond 0 and, with lengths (chrom, length), not beyond their chromosome's end.

    With lengths, intervals of chromosomes that have none are an error when the row is read.
    """
    low = F.greatest(F.col("start") - slop, F.lit(0))
    if lengths is None:
        return df.withColumns({"start": low, "end": F.col("end") + slop})
    j = df.join(lengths.select("chrom", F.col("length").alias("_length")), "chrom", "left")
    bound = F.coalesce("_length", F.raise_error(F.concat_ws(" ", F.lit("a chromosome without a length:"), "chrom")).cast("long"))
    return j.withColumns({"start": low, "end": F.least(F.col("end") + slop, bound)}).drop("_length").select(*df.columns)


def merged(df: DataFrame, slop: int = 0, stretch: int = 10_000_000, lengths: DataFrame | None = None) -> DataFrame:
    """Union of the intervals of each chromosome, each widened by `slop` on both sides, book-ended ones included.

    With lengths (chrom, length) they end where their chromosome does.

    Chromosomes are swept in stretches of `stretch` bases, each its own task: what reaches into a stretch from those before it is the
    largest end of any of them, from a table of one row a stretch.
    """
    wide = widened(df.select("chrom", "start", "end"), slop, lengths).distinct().withColumn("_s", F.floor(F.col("start") / stretch))
    ahead = Window.partitionBy("chrom").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    reach = wide.groupBy("chrom", "_s").agg(F.max("end").alias("_top")).select("chrom", "_s", F.max("_top").over(ahead).alias("_reach"))
    w = Window.partitionBy("chrom", "_s").orderBy("start", "end")
    before = F.greatest(F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    fresh = wide.join(reach, ["chrom", "_s"]).withColumn("_before", before).withColumn("_new", F.when(F.col("_before").isNull() | (F.col("start") > F.col("_before")), F.col("start")))
    # an island is named by where it starts: the last start of one in this stretch, or else in those before
    carried = fresh.groupBy("chrom", "_s").agg(F.max("_new").alias("_last")).select("chrom", "_s", F.max("_last").over(ahead).alias("_open"))
    island = fresh.join(carried, ["chrom", "_s"]).withColumn("_island", F.coalesce(F.max("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open")))
    return island.groupBy("chrom", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def _swept(steps: DataFrame, stretch: int) -> DataFrame:
    """Steps (chrom, at, step, ...), one a place, with the running sum `level` of step and the next place `_next` of their chromosome.

    Chromosomes are swept in stretches of `stretch` places, each its own task; the sums and first places of the stretches are a table of
    one row each, whose windows carry them on.
    """
    s = steps.withColumn("_s", F.floor(F.col("at") / stretch))
    order = Window.partitionBy("chrom").orderBy("_s")
    each = s.groupBy("chrom", "_s").agg(F.sum("step").alias("_sum"), F.min("at").alias("_first"))
    carried = each.select("chrom", "_s", F.coalesce(F.sum("_sum").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(order).alias("_after"))
    w = Window.partitionBy("chrom", "_s").orderBy("at")
    run = s.join(carried, ["chrom", "_s"]).withColumn("level", F.col("_before") + F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.withColumn("_next", F.coalesce(F.lead("at").over(w), F.col("_after"))).drop("_s", "_before", "_after")


def depth_runs(reads: DataFrame, stretch: int = 10_000_000) -> DataFrame:
    """Rows (chrom, start, end, depth) of equal depth above 0: starts count up and ends down, whatever lies between. Empty intervals count nothing."""
    some = reads.where("start < end")
    ends = some.select("chrom", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("step")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("step")))).alias("x")).select("chrom", "x.*")
    steps = ends.groupBy("chrom", "at").agg(F.sum("step").alias("step")).where("step != 0")
    return _swept(steps, stretch).where("level > 0").select("chrom", F.col("at").alias("start"), F.col("_next").alias("end"), F.col("level").alias("depth"))


def window_depth(reads: DataFrame, width: int, stretch: int = 10_000) -> DataFrame:
    """Mean depth of every window of `width` that a read touches; stretch: windows that one task sweeps.

    A read gives four rows at most: what it covers of its first and last window, and where whole windows between begin and end. Rows for
    each window come into being at the end alone, once for all reads.
    """
    first, last = F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)
    row = lambda at, part, step: F.struct(at.alias("at"), part.cast("long").alias("part"), F.lit(step).cast("long").alias("step"))
    one = F.array(row(first, F.col("end") - F.col("start"), 0))
    many = F.array(row(first, (first + 1) * width - F.col("start"), 0), row(last, F.col("end") - last * width, 0), row(first + 1, F.lit(0), 1), row(last, F.lit(0), -1))
    rows = reads.where("start < end").select("chrom", F.explode(F.when(first == last, one).otherwise(many)).alias("x")).select("chrom", "x.*")
    swept = _swept(rows.groupBy("chrom", "at").agg(F.sum("part").alias("part"), F.sum("step").alias("step")), stretch)
    here = swept.select("chrom", "at", (F.col("part") + F.col("level") * width).alias("bases"))
    between = swept.where("level > 0 and _next > at + 1").select("chrom", F.explode(F.sequence(F.col("at") + 1, F.col("_next") - 1)).alias("at"), (F.col("level") * width).alias("bases"))
    return here.union(between).where("bases > 0").select("chrom", (F.col("at") * width).alias("start"), (F.col("bases") / width).alias("depth"), ((F.col("at") + 1) * width).alias("end"))


def target_depth(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (chrom, start, end, ...) with their mean depth, 0 where no read lies; empty targets have none (null).

    Targets meet runs of equal depth, not reads, so a very deep place costs one row. Equal targets are one row.
    """
    met = overlaps(targets, depth_runs(reads))
    covered = (F.least("end", "end2") - F.greatest("start", "start2")) * F.col("depth")
    sums = met.groupBy(*targets.columns).agg(F.sum(covered).alias("_bases"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in targets.columns]
    on = same[0]
    for x in same[1:]:
        on = on & x
    j = targets.distinct().alias("t").join(sums.alias("s"), on, "left")
    return j.select("t.*", (F.coalesce("s._bases", F.lit(0)) / F.nullif(F.col("t.end") - F.col("t.start"), F.lit(0))).alias("depth"))


def deep(depths: DataFrame, limit: float) -> DataFrame:
    """Windows (chrom, start, end, depth) deeper than the limit, without their depth."""
    return depths.where(F.col("depth") > limit).drop("depth")


def deepest_locus(depths: DataFrame, slop: int, lengths: DataFrame) -> DataFrame:
    """One row (locus): the deepest window, widened by slop within its chromosome, as chrom:start-end. The first one of equals; none without windows."""
    top = depths.groupBy().agg(F.min_by(F.struct("chrom", "start", "end"), F.struct(-F.col("depth"), "chrom", "start")).alias("x")).where("x is not null").select("x.*")
    return widened(top, slop, lengths).select(F.concat("chrom", F.lit(":"), "start", F.lit("-"), "end").alias("locus"))
