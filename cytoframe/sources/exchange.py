"""Matrices in market-exchange folders (barcodes.tsv, features.tsv, matrix.mtx, each a folder of text parts) and as wide tables.

Parts are written in order: the counts of each part of an axis give its first number, so no sort or numbering meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.operators.matrix import Matrix
from cytoframe.operators.ranks import numbered

METADATA = '%metadata_json: {"format_version": 2}'


def axis_places(axis: DataFrame, column: str, to: str) -> DataFrame:
    """Distinct values of an axis with their 1-based place in byte order."""
    return numbered(axis.select(column).distinct(), to, column)


def write_exchange(m: Matrix, path: str, *, feature_type: str = "Gene Expression", feature_ids: DataFrame | None = None, suffix: str = "-1", integer: bool = True) -> None:
    """Writes a matrix; features without an id (feature_ids: feature, id) are called unknown_00000 onwards by their place.

    Values are written as they are stored, zeros of genotypes too. The two axes are written tables before they are numbered, so both
    files see the same ranges.
    """
    spark = m.values.sparkSession
    f, c = axis_places(m.features, "feature", "row"), axis_places(m.cells, "cell", "col")
    named = f.withColumn("id", F.lit(None).cast("string")) if feature_ids is None else f.join(feature_ids.select("feature", "id"), "feature", "left")
    gz = lambda df, name: df.write.option("compression", "gzip").text(f"{path}/{name}")
    label = F.coalesce("id", F.concat(F.lit("unknown_"), F.lpad((F.col("row") - 1).cast("string"), 5, "0")))
    gz(named.select(F.concat_ws("\t", label, "feature", F.lit(feature_type)).alias("value"), "row").repartitionByRange("row").sortWithinPartitions("row").select("value"), "features.tsv")
    gz(c.repartitionByRange("col").sortWithinPartitions("col").select(F.concat("cell", F.lit(suffix)).alias("value")), "barcodes.tsv")
    value = F.col("value").cast("long") if integer else F.col("value")
    gz(m.values.join(f, "feature").join(c, "cell").select(F.concat_ws(" ", "row", "col", value.cast("string")).alias("value")), "matrix.mtx/entries")
    size = [m.features.distinct().count(), m.cells.distinct().count(), m.values.count()]
    head = [f"%%MatrixMarket matrix coordinate {'integer' if integer else 'real'} general", METADATA, " ".join(map(str, size))]
    gz(spark.createDataFrame([("\n".join(head),)], "value string"), "matrix.mtx/header")


def _lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Lines of an axis file with their 1-based place."""
    lines = spark.read.text(path)
    at = lines.select("value", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_i"))
    first = at.groupBy("_file").agg(F.min("_i").alias("_from"), F.count("*").alias("_n"))
    # one row a file
    before = first.select("_file", "_from", (F.sum("_n").over(Window.orderBy("_file")) - F.col("_n")).alias("_before"))
    return at.join(before, "_file").select("value", (F.col("_before") + F.col("_i") - F.col("_from") + 1).alias(name))


def read_exchange(spark: SparkSession, path: str, *, suffix: str = "-1") -> Matrix:
    """The matrix that a folder of write_exchange holds. Axis files are compressed parts, which are never split."""
    f = _lines(spark, f"{path}/features.tsv", "row").select("row", F.split("value", "\t")[1].alias("feature"))
    c = _lines(spark, f"{path}/barcodes.tsv", "col").select("col", F.regexp_replace("value", f"\\Q{suffix}\\E$", "").alias("cell"))
    e = F.split("value", " ")
    entries = spark.read.text(f"{path}/matrix.mtx/entries").select(e[0].cast("long").alias("row"), e[1].cast("long").alias("col"), e[2].cast("double").alias("value"))
    return Matrix(entries.join(f, "row").join(c, "col").select("feature", "cell", "value"), f.select("feature"), c.select("cell"))


def write_table(m: Matrix, path: str, cells: list[str]) -> None:
    """A tab-separated table with one column a listed cell, zeros filled in, features in byte order."""
    m.dense(cells).orderBy("feature").write.option("sep", "\t").option("header", True).csv(path)
