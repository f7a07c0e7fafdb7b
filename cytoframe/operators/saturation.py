"""Sequencing saturation: how many UMIs a share of the reads shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.matrix import FRACTIONS

UMI = ("UB", "CB", "gene")


def curve(reads: DataFrame, draw: Column, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
    """Rows (frac, n_reads, n_umis, saturation) for nested samples of reads (UB, CB, gene); draw: a 64-bit hash that tells reads apart.

    One pass keeps the smallest hash of every distinct UMI, then counts those below each fraction, so a sample holds all smaller ones and
    a task that runs again draws the same reads. An empty sample has saturation 0.
    """
    n = range(len(fractions))
    read = reads.withColumn("_u", F.pmod(draw, F.lit(1 << 40)) / float(1 << 40))
    per = read.groupBy(*UMI).agg(F.min("_u").alias("_m"), *[F.count_if(F.col("_u") < f).alias(f"_r{i}") for i, f in enumerate(fractions)])
    wide = per.agg(*[F.coalesce(F.sum(f"_r{i}"), F.lit(0)).alias(f"_r{i}") for i in n], *[F.count_if(F.col("_m") < f).alias(f"_n{i}") for i, f in enumerate(fractions)])
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("frac"), F.col(f"_r{i}").alias("n_reads"), F.col(f"_n{i}").alias("n_umis")) for i, f in enumerate(fractions)]))
    return with_saturation(wide.select(rows.alias("x")).select("x.*"))


def with_saturation(table: DataFrame) -> DataFrame:
    return table.withColumn("saturation", F.coalesce(1 - F.try_divide("n_umis", "n_reads"), F.lit(0.0)))


def added(*tables: DataFrame) -> DataFrame:
    """Sum of the curves of several shards, none of which shares a UMI with another."""
    from functools import reduce

    every = reduce(DataFrame.unionByName, [t.select("frac", "n_reads", "n_umis") for t in tables])
    return with_saturation(every.groupBy("frac").agg(F.sum("n_reads").alias("n_reads"), F.sum("n_umis").alias("n_umis")))


def zero(spark, fractions: tuple[float, ...] = FRACTIONS) -> DataFrame:
    """The curve of no reads."""
    return with_saturation(spark.createDataFrame([(f, 0, 0) for f in fractions], "frac double, n_reads long, n_umis long"))
