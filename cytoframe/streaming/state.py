"""The expression matrix as the state of a stream: UMIs in the state store, changed entries out, and looks at a committed state.

Two of Spark's own stateful operators: one knows the UMIs of each gene and cell, so a row that brings a new one is told apart; the other
holds the reads of each UMI, and for each gene and cell its UMIs and reads. A batch reads and writes only the entries and UMIs that it
touches and hands on the entries that changed. The state is kept in RocksDB, on disk where it is large, and saved with the stream's
checkpoint, so a restart or a batch that runs again gives the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoframe.operators.matrix import Matrix

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEY = ("gene", "CB", "UB")


def umi_changes(tags: DataFrame) -> DataFrame:
    """A stream of tags (gene, CB, UB) as a stream of changed entries (gene, CB, n_umis, n_reads), for output mode update.

    Rows without gene, cell or UMI (null, or '-' for unknown) are left out. A batch gives each entry that it touches once, with its whole
    counts so far.
    """
    tags.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    known = tags.select(*KEY).where("gene != '-' and CB != '-' and UB != '-'")
    entry = F.lit(None).cast(known.schema["UB"].dataType)
    # a row is a read of its UMI and of its entry, whose UB is null; the first row of a UMI also adds that UMI to the entry
    rows = known.select("gene", "CB", F.explode(F.array(F.col("UB"), entry)).alias("UB"), F.lit(0).cast("long").alias("umi"), F.lit(True).alias("read"))
    fresh = known.dropDuplicates(list(KEY)).select("gene", "CB", entry.alias("UB"), F.lit(1).cast("long").alias("umi"), F.lit(None).cast("boolean").alias("read"))
    sums = rows.unionByName(fresh).groupBy(*KEY).agg(F.sum("umi").alias("n_umis"), F.count("read").alias("n_reads"))
    # entries have UMIs; a condition on UB would move below the sums and keep the UMIs' reads out of the state
    return sums.where("n_umis > 0").select("gene", "CB", "n_umis", "n_reads")


def write_changes(changes: DataFrame, path: str):
    """A stream yet to be started that writes each batch's changed entries to a folder of its own under `path`.

    The folder of a batch that runs again is written anew with the same rows, since its state is the same. Returns a DataStreamWriter;
    the caller sets trigger and checkpoint.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(put)


def _sums(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows (gene, CB, UB, n_umis, n_reads) of the last committed batch's sums: UMIs, and with UB null entries."""
    held = spark.read.format("state-metadata").load(checkpoint).where("operatorName = 'stateStoreSave'").first()
    rows = spark.read.format("statestore").option("operatorId", held["operatorId"]).load(checkpoint)
    return rows.select("key.*", F.col("value.sum").alias("n_umis"), F.col("value.count").alias("n_reads"))


def entries(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows (gene, CB, n_umis, n_reads) of the last committed batch's state, one row an entry."""
    return _sums(spark, checkpoint).where("UB is null").select("gene", "CB", "n_umis", "n_reads")


def umis(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows (gene, CB, UB, n_reads) of the last committed batch's state."""
    return _sums(spark, checkpoint).where("UB is not null").select("gene", "CB", "UB", "n_reads")


def matrix(spark: SparkSession, checkpoint: str) -> Matrix:
    """Distinct UMIs of each gene and cell so far."""
    return Matrix.from_values(entries(spark, checkpoint).select(F.col("gene").alias("feature"), F.col("CB").alias("cell"), F.col("n_umis").alias("value")))


def saturation(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row: reads, UMIs and the saturation 1 - UMIs / reads so far, from the entries' totals."""
    one = entries(spark, checkpoint).agg(F.coalesce(F.sum("n_reads"), F.lit(0)).alias("n_reads"), F.coalesce(F.sum("n_umis"), F.lit(0)).alias("n_umis"))
    return one.withColumn("saturation", F.coalesce(1 - F.try_divide("n_umis", "n_reads"), F.lit(0.0)))
