"""Matrix counts: rows are dealt out before they are told apart, and counts stay those of distinct UMIs."""

from pyspark.sql import functions as F

from cytoframe.operators.matrix import Matrix


def test_counts_of_dealt_rows(spark):
    tags = [("g1", "c1", 1), ("g1", "c1", 1), ("g1", "c1", 2), ("g1", "c1", None), ("g2", "c1", None), ("-", "c2", 5), (None, "c1", 3)]
    df = spark.createDataFrame(tags, "gene string, cb string, ub long")
    plan = Matrix.from_tags(df).values._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "Aggregate" not in plan.split("REPARTITION_BY_NUM")[-1]
    rows = lambda m: {(r.feature, r.cell): r.value for r in m.values.collect()}
    assert rows(Matrix.from_tags(df)) == {("g1", "c1"): 2, ("g2", "c1"): 0}
    assert rows(Matrix.from_tags(df, unknown=True)) == {("g1", "c1"): 2, ("g2", "c1"): 0, ("-", "c2"): 1, (None, "c1"): 1}
    assert rows(Matrix.from_tags(df, umi=F.struct("cb", "ub"))) == {("g1", "c1"): 3, ("g2", "c1"): 1}
