"""Summary tables of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.sources import alignments as sam


def expression(tags: DataFrame) -> DataFrame:
    """Rows (statistic, count): reads with a barcode, a gene, a transcript, and distinct genes and transcripts, told apart by chromosome.

    tags: chr, CB, gene, transcript; '-' is unknown.
    """
    known = lambda c: F.col(c) != "-"
    one = tags.agg(F.count_if(known("CB")).alias("valid_barcodes"), F.count_if(known("gene")).alias("gene_tagged"), F.count_if(known("transcript")).alias("transcript_tagged"), F.countDistinct(F.when(known("gene"), F.struct("chr", "gene"))).alias("genes"), F.countDistinct(F.when(known("transcript"), F.struct("chr", "transcript"))).alias("transcripts"))
    return one.unpivot([], one.columns, "statistic", "count")


def added(*tables: DataFrame) -> DataFrame:
    """Sum of tables (statistic, count) of several shards."""
    return reduce(DataFrame.unionByName, tables).groupBy("statistic").agg(F.sum("count").alias("count"))


def alignment_stats(alignments: DataFrame, sample: str) -> DataFrame:
    """One row: sample, reads_aligned (all records) and the records by flag."""
    return sam.flag_counts(alignments).select(F.lit(sample).alias("sample"), F.col("total").alias("reads_aligned"), "primary", "secondary", "supplementary", "unmapped")


def survival(statistics: DataFrame, reads: int, cells: DataFrame | None = None, *, sample: str = "") -> DataFrame:
    """statistics (statistic, count) with the input reads, cells and reads a cell, as shares of the reads and of the full-length ones."""
    rows = statistics.select("statistic", F.col("count").cast("double").alias("count"))
    more = rows.sparkSession.createDataFrame([("reads", float(reads))], "statistic string, count double")
    if cells is not None:
        n = cells.agg(F.count("*").cast("double").alias("count"))
        more = more.union(n.select(F.lit("cells"), "count")).union(n.select(F.lit("mean_reads_per_cell"), F.try_divide(F.lit(float(reads)), "count")))
    every = rows.union(more)
    full = every.where("statistic = 'full_length'").agg(F.max("count").alias("_full"))
    return every.join(F.broadcast(full)).select("statistic", "count", F.try_divide(100.0 * F.col("count"), F.lit(float(reads))).alias("pct_of_input_reads"), F.try_divide(100.0 * F.col("count"), F.col("_full")).alias("pct_of_fl_reads"), F.lit(sample).alias("sample_id"))


def key_sums(tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """Sum of `value` by `key` over several tables."""
    return reduce(DataFrame.unionByName, [t.select(key, value) for t in tables]).groupBy(key).agg(F.sum(value).alias(value))


def run_info(reads: DataFrame) -> DataFrame:
    """Rows (sample, n_seqs, run_ids, basecallers) from reads (sample, comment) whose comments hold runid= and basecall model fields."""
    field = lambda p: F.nullif(F.regexp_extract("comment", p, 1), F.lit(""))
    found = reads.select("sample", field(r"runid=([^\s]+)").alias("_run"), field(r"basecall_model_version_id=([^\s]+)").alias("_model"))
    names = lambda c: F.array_sort(F.collect_set(c))
    return found.groupBy("sample").agg(F.count("*").alias("n_seqs"), names("_run").alias("run_ids"), names("_model").alias("basecallers"))


def one_basecaller(info: DataFrame, *, allow_many: bool = False) -> DataFrame:
    """Samples whose reads come from one basecaller at most, or all."""
    return info if allow_many else info.where(F.size("basecallers") <= 1)


def cell_table(matrix, embedding: DataFrame, genes: list[str], mito: list[str]) -> DataFrame:
    """One row a cell of the embedding: its coordinates, mean expression, share of mitochondrial counts and counts of the genes of interest."""
    own = matrix.dense_genes(genes)
    return embedding.join(matrix.mean_expression(), "cell").join(matrix.share(mito).withColumnRenamed("share", "mito_share"), "cell").join(own, "cell", "left").na.fill(0, subset=genes)


def genes_of_interest(matrix, names: DataFrame, coordinates: DataFrame | None = None) -> DataFrame:
    """Rows (gene, barcode, count, x, y): entries of the genes in names (name), with their cell's place.

    Places come from a table (cell, x, y), or without one from the cells' names; where a cell has none they are null. Genes that the
    matrix lacks have no rows. A cell that the table names twice has a row for each place.
    """
    own = matrix.values.join(names.select(F.col("name").alias("feature")), "feature", "left_semi")
    place = matrix.coordinates() if coordinates is None else coordinates.select("cell", "x", "y")
    return own.join(place, "cell", "left").select(F.col("feature").alias("gene"), F.col("cell").alias("barcode"), F.col("value").alias("count"), "x", "y")
