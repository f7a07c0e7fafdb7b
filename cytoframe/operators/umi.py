"""Directional clustering of UMIs, as joins over shared deletion variants and rounds along edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.sources.scratch import written

EDITS = 2
GROUP = ["gene", "cb"]
FEW = 24  # groups of so many UMIs at most are compared whole; larger ones by variants


def variants(edits: int) -> Column:
    """Hashes of what deletions make of a UMI. Strings of one hash only meet, so equal hashes of others cost a comparison."""
    return F.array_distinct(F.transform(seq.deletions(F.col("ur"), edits), lambda x: F.xxhash64(x)))


def near_pairs(umis: DataFrame, *, edits: int = EDITS) -> DataFrame:
    """Rows (gene, cb, ur, ur2, n, n2) for all ordered pairs of UMIs of one gene and cell within so many edits, of any lengths.

    Small groups are compared whole. In larger ones, UMIs meet that share a string which deleting up to `edits` bases gives of both: UMIs
    within so many edits do, whatever their lengths, and others seldom, so candidates grow with the near pairs and not with the square of
    a group. levenshtein decides before pairs are made distinct.
    """
    size = umis.groupBy(*GROUP).agg(F.count("*").alias("_size")).where("_size > 1")
    sized = umis.join(size, GROUP)
    near = (F.col("ur") != F.col("ur2")) & (F.levenshtein("ur", "ur2", edits) >= 0)
    few = sized.where(F.col("_size") <= FEW)
    whole = few.select(*GROUP, "ur", "n").join(few.select(*GROUP, F.col("ur").alias("ur2"), F.col("n").alias("n2")), GROUP).where(near)
    umis = sized.where(F.col("_size") > FEW)
    left = umis.select(*GROUP, "ur", "n", F.explode(variants(edits)).alias("_p"))
    right = left.select(*GROUP, F.col("ur").alias("ur2"), F.col("n").alias("n2"), "_p")
    names = [*GROUP, "ur", "ur2", "n", "n2"]
    return whole.select(*names).union(left.join(right, [*GROUP, "_p"]).where(near).select(*names).distinct())


def representatives(counts: DataFrame, *, edits: int = EDITS) -> DataFrame:
    """counts (gene, cb, ur, n), one row a UMI, with ub: the best-ranked UMI (count down, then name) that reaches it.

    An edge leads from u to v where they are near and n(u) >= 2 n(v) - 1. The best rank moves along the edges, a round a table, until
    none changes; only UMIs with an edge take part, and only ranks that changed move on.
    """
    edges = near_pairs(counts.where("gene is not null and cb is not null and ur is not null"), edits=edits).where("n >= 2 * n2 - 1")
    edges = written(edges, "umi-edges")
    rank = F.struct((-F.col("n")).alias("_n"), F.col("ur").alias("_ur"))
    sources = edges.select(*GROUP, "ur", rank.alias("_best"))
    targets = edges.select(*GROUP, F.col("ur2").alias("ur"), F.struct((-F.col("n2")).alias("_n"), F.col("ur2").alias("_ur")).alias("_best"))
    state = written(sources.union(targets).distinct().withColumn("_new", F.lit(True)), "umi-ranks")
    step = edges.select(*GROUP, "ur", F.col("ur2").alias("_to"))
    while True:
        moved = step.join(state.where("_new").drop("_new"), [*GROUP, "ur"]).groupBy(*GROUP, F.col("_to").alias("ur")).agg(F.min("_best").alias("_come"))
        better = F.coalesce(F.col("_come") < F.col("_best"), F.lit(False))
        state = written(state.drop("_new").join(moved, [*GROUP, "ur"], "left").select(*GROUP, "ur", F.when(better, F.col("_come")).otherwise(F.col("_best")).alias("_best"), better.alias("_new")), "umi-ranks")
        if state.where("_new").isEmpty():
            break
    return counts.join(state.select(*GROUP, "ur", F.col("_best._ur").alias("_ub")), [*GROUP, "ur"], "left").select(*counts.columns, F.coalesce("_ub", "ur").alias("ub"))


def cluster(reads: DataFrame, *, edits: int = EDITS, length: int | None = None) -> DataFrame:
    """Distinct (gene, cb, ur) with the corrected UMI ub; with `length`, only those whose ub has that many bases.

    Reads are counted first. Rows with a null in gene, cell or UMI keep their UMI.
    """
    out = representatives(reads.groupBy(*GROUP, "ur").agg(F.count("*").alias("n")), edits=edits).drop("n")
    return out if length is None else out.where(F.length("ub") == length)


def cluster_by_region(reads: DataFrame, region: Column, *, edits: int = EDITS, length: int | None = None) -> DataFrame:
    """cluster() where reads without a gene ('-') are grouped by their region; the result has that label in _group and the gene as it came."""
    grouped = reads.withColumn("_group", F.when(F.col("gene") == "-", region).otherwise(F.col("gene")))
    clustered = cluster(grouped.select(F.col("_group").alias("gene"), "cb", "ur"), edits=edits, length=length)
    genes = grouped.select("gene", "_group", "cb", "ur").distinct()
    return genes.join(clustered.withColumnRenamed("gene", "_group"), ["_group", "cb", "ur"]).select("gene", "_group", "cb", "ur", "ub")
