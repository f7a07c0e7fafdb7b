"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.shared import release, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): each node of an edge with the smallest node it reaches.

    Every round links each node's larger neighbours, then its smaller ones, to the smallest of them; stars remain when nothing
    changes, after about log(size) rounds. Minima are combined before each exchange, so a node with many neighbours costs no task
    more than its share; each round is a written table, so no lineage grows and a lost executor costs one round at most.
    Self-loops, nulls and repeated edges are left out. No edges give no rows.
    """
    e = F.col(a) != F.col(b)
    now = written(edges.where(e).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).where("u != v").distinct()
        small = written(small, "edges")
        release(now, large)
        now = small
        after = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(roots)
