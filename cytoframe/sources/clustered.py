"""Tables clustered by keys: rows of one key lie in one bucket, sorted, so joins and groupings on the keys need no exchange.

A run joins tags, features and mappings on the read several times and goes through cells chromosome by chromosome. Written once by
those keys, with the same number of buckets, the tables meet bucket by bucket.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.sources.scratch import scratch_path

BY_READ, BY_CELL = ("read_id",), ("chr", "CB")
BUCKETS = 64


def table_name(kind: str) -> str:
    """A name that no other table has."""
    return f"{kind}_{uuid.uuid4().hex}"


def write_clustered(df: DataFrame, table: str, *keys: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """df as a table whose rows are clustered and sorted by the keys; `path` is its folder, a scratch one by default. Returns the table.

    One exchange into as many partitions as buckets, so that a bucket is one file; rows of one key stay together, and where one key holds
    a large share of all rows its bucket is as large.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", path or scratch_path(spark, table)).mode("errorifexists").saveAsTable(table)
    return spark.table(table)


def drop_clustered(spark: SparkSession, table: str) -> None:
    """Forgets the table and deletes its folder."""
    row = spark.sql(f"describe formatted {table}").where("col_name = 'Location'").select("data_type").first()
    spark.sql(f"drop table {table}")
    if row is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(row[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_tags(tags: DataFrame, by_cell: str, split: str, *, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Tags with a cell and a UMI as a table by chromosome and cell, and those of split alignments (SA not '-') as one by read as well.

    Reads of split alignments stand in both: their tags go to alignments on every chromosome.
    """
    known = tags.where("CB != '-' and UR != '-'")
    return write_clustered(known, by_cell, *BY_CELL, buckets=buckets), write_clustered(known.where("SA != '-'"), split, *BY_READ, buckets=buckets)


def cell_totals(tags: DataFrame) -> DataFrame:
    """Rows (chr, CB, n_reads, n_umis, n_genes) of tags (chr, CB, UB, gene): one pass over the buckets of a table by cell."""
    return tags.groupBy("chr", "CB").agg(F.count("*").alias("n_reads"), F.size(F.collect_set("UB")).alias("n_umis"), F.size(F.array_remove(F.collect_set("gene"), "-")).alias("n_genes"))


def joined_by_read(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Inner join on read_id of tables by read."""
    return reduce(lambda a, b: a.join(b, "read_id"), others, first)
