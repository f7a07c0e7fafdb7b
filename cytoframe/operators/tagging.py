"""Tags of reads: joining barcodes, features and mappings, and putting them on alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.ranks import numbered
from cytoframe.sources.alignments import tag_alignments


def with_barcodes(mappings: DataFrame, barcodes: DataFrame, split: DataFrame | None = None) -> DataFrame:
    """Mappings with the barcodes of their read and SA: the read's id where it has a split alignment, '-' elsewhere.

    Every mapping stays; split (read_id) may repeat ids, or be missing where no read is split.
    """
    out = mappings.join(barcodes, "read_id", "left")
    if split is None:
        return out.withColumn("SA", F.lit("-"))
    own = split.select("read_id", F.col("read_id").cast("string").alias("SA")).dropDuplicates(["read_id"])
    return out.join(own, "read_id", "left").withColumn("SA", F.coalesce("SA", F.lit("-")))


def with_features(tags: DataFrame, features: DataFrame) -> DataFrame:
    """Tags with the features of their read; what is unknown is '-' in every text column."""
    return tags.join(features, "read_id", "left").na.fill("-")


def usable(tags: DataFrame) -> DataFrame:
    """Tags that have a corrected barcode and a UMI."""
    return tags.where("CB != '-' and UR != '-'")


def occurrences(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows with _k: which of the rows of their key they are, from 0, in the given order.

    Rows are numbered in ranges of key and order, and a key's smallest number is taken off, so a key of very many rows is spread.
    """
    ranked = numbered(df, "_k", key, *order)
    first = ranked.groupBy(key).agg(F.min("_k").alias("_first"))
    return ranked.join(first, key).withColumn("_k", F.col("_k") - F.col("_first")).drop("_first")


def in_order(left: DataFrame, right: DataFrame, key: str = "read_id", *, left_order: tuple[str, ...] = (), right_order: tuple[str, ...] = ()) -> DataFrame:
    """Inner join of two tables by id, an id's k-th row of the one with its k-th row of the other; rows without a partner go.

    What the k-th row is follows from the orders: columns of either side, by default all but the id. Rows that agree in them are alike.
    """
    rest = lambda df, order: order or tuple(c for c in df.columns if c != key)
    return occurrences(left, key, *rest(left, left_order)).join(occurrences(right, key, *rest(right, right_order)), [key, "_k"]).drop("_k")


def tags_of_alignments(alignments: DataFrame, tags: DataFrame) -> DataFrame:
    """Tags of every alignment (read_id, chr): those of its read on its own chromosome, and those of split reads (SA) on any.

    tags: read_id, chr, SA and tag columns. Where both apply, the split read's count once.
    """
    a = alignments.select("read_id", F.col("chr").alias("_at"))
    j = a.join(tags, "read_id").where((F.col("_at") == F.col("chr")) | (F.col("SA") != "-"))
    return j.drop("chr").withColumnRenamed("_at", "chr").dropDuplicates(["read_id", "chr"])


def tagged(alignments: DataFrame, tags: DataFrame) -> DataFrame:
    """Alignments with their read's tags in the map; those without tags go."""
    own = tags_of_alignments(alignments.select("read_id", "chr").distinct(), tags)
    key = F.concat_ws("\t", "read_id", "chr")
    # reads are told apart by chromosome here, as tags may differ between them
    keyed = alignments.withColumn("_read", F.col("read_id")).withColumn("read_id", key)
    out = tag_alignments(keyed, own.withColumn("read_id", key).drop("chr", "SA"))
    return out.withColumn("read_id", F.col("_read")).drop("_read").select(*alignments.columns)
