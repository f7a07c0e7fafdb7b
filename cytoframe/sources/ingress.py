"""Finding input files, and text files put together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FASTQ = (".fastq", ".fastq.gz", ".fq", ".fq.gz")
ALIGNED = (".bam", ".ubam", ".sam", ".sam.gz")


def discover(spark: SparkSession, folder: str, extensions: tuple[str, ...] = FASTQ) -> DataFrame:
    """Rows (sample, path): input files of a folder, the sample named by the sub-folder, or null where files stand in the folder itself.

    Files of other extensions and paths with a part `unclassified` or one that ends in `_fail` are left out. Files in the folder and in
    sub-folders at once, or deeper than one level, are errors. Only names are read; empty files have no reads and are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString()
    inner = F.regexp_replace(F.substring(F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/"), len(root.replace("///", "/").replace("//", "/")) + 1, 1 << 30), "^/+", "")
    wanted = reduce(lambda a, b: a | b, [F.col("path").endswith(e) for e in extensions])
    parts = F.split(inner, "/")
    left_out = F.exists(parts, lambda p: (p == "unclassified") | p.endswith("_fail"))
    found = files.where(wanted).select("path", parts.alias("_parts")).where(~left_out)
    found = found.select(F.when(F.size("_parts") > 1, F.col("_parts")[0]).alias("sample"), "path", (F.size("_parts") - 1).alias("_depth"))
    low, high = found.agg(F.min("_depth"), F.max("_depth")).first()
    if high is not None and high > 1:
        raise ValueError("input files lie deeper than one sub-folder")
    if low is not None and low != high:
        raise ValueError("input files lie in the folder and in sub-folders")
    return found.drop("_depth")


def alias(name):
    """A sample's alias without blanks."""
    return F.translate(name, " ", "_")


def merged_annotation(*lines: DataFrame) -> DataFrame:
    """Lines (value) of several annotation files without their comments."""
    return reduce(DataFrame.unionByName, lines).where("not startswith(value, '#')")


def concatenated(spark: SparkSession, paths: list[str], *, sep: str = "\t") -> DataFrame:
    """Rows of several tables with a header each, as one table with the columns of the first."""
    tables = [spark.read.option("header", True).option("sep", sep).csv(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b.select(*a.columns)), tables)


def write_one_header(table: DataFrame, path: str, *, sep: str = "\t") -> None:
    """A folder of text parts that, one after the other, are one table with one header: header first, then the rows."""
    spark = table.sparkSession
    spark.createDataFrame([(sep.join(table.columns),)], "value string").coalesce(1).write.text(f"{path}/0-header")
    table.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in table.columns]).alias("value")).write.text(f"{path}/1-rows")


def split_by(table: DataFrame, key: str, path: str) -> None:
    """One folder of parts a value of the key."""
    table.write.partitionBy(key).option("sep", "\t").option("header", True).csv(path)


def write_statistics(table: DataFrame, path: str) -> None:
    """A table (statistic, count) as JSON lines."""
    table.select("statistic", "count").write.json(path)


def read_statistics(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Sum of the tables of write_statistics()."""
    return spark.read.schema("statistic string, count double").json(paths).groupBy("statistic").agg(F.sum("count").alias("count"))
