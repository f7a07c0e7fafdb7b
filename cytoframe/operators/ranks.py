"""Global row numbers without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoframe.sources.scratch import written


def numbered(df: DataFrame, to: str, *order: str | Column) -> DataFrame:
    """df with its rows' 1-based places in the given order, which must be total for the places to be fixed.

    Rows are dealt to ranges and sorted there; the ranges' sizes, one small row each, give the first number of each. The ranges are a
    written table, so a task that runs again cannot move their edges.
    """
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")), "ranges")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row a range
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(before, "_part").select(*df.columns, (F.col("_before") + F.col("_at") + 1).cast("long").alias(to))
