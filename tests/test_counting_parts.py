"""Counting distinct UMIs: the number of parts follows the rows, and the UMIs of one feature and cell are dealt to several."""

import re

from pyspark.sql import functions as F

from cytoframe.operators import matrix


def test_parts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(matrix, "ROWS_A_TASK", 100, raising=False)
    df = spark.range(2_000).select(F.lit("g").alias("gene"), F.lit("c").alias("cb"), (F.col("id") % 1_500).alias("ub"))
    values = matrix.Matrix.from_tags(df).values
    dealt = re.findall(r"hashpartitioning\((.*), (\d+)\), REPARTITION_BY_NUM", values._jdf.queryExecution().executedPlan().toString())
    assert len(dealt) == 2 and {n for _, n in dealt} == {"20"}
    assert [tuple(r) for r in values.collect()] == [("g", "c", 1_500)]
    one = df.select(F.pmod(F.xxhash64("ub"), F.lit(matrix.SALTS)).alias("_part")).distinct().count()
    assert one == matrix.SALTS
