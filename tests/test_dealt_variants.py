"""Deletion variants as rows: the same strings as the column gives, and dealt out whatever the table before was dealt by."""

import random

from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators import barcodes


def test_variants_of_a_string(spark):
    g = random.Random(3)
    own = sorted({"".join(g.choice("ACGT") for _ in range(g.choice([0, 1, 2, 5, 9, 16]))) for _ in range(60)} | {"", "AAAA", "ABAB"})
    df = spark.createDataFrame([(x,) for x in own] + [(None,)], "cr string")
    for edits in (1, 2, 3):
        rows = [tuple(r) for r in barcodes._variants(df, "cr", edits).collect()]
        want = df.where("cr is not null").select("cr", F.explode(F.transform(seq.deletions(F.col("cr"), edits), lambda x: F.xxhash64(x)))).collect()
        assert set(rows) == {tuple(r) for r in want}
        long = [r for r in rows if len(r[0]) == 16]
        assert len(long) < 1.2 * len(set(long))


def test_strings_of_an_aggregate_are_dealt_out(spark):
    """An aggregate's exchange by the string is small and would be put together into one task; the one of the variants must stay."""
    some = spark.createDataFrame([("ACGTACGT",), ("ACGTACGA",)], "cr string").groupBy("cr").count().select("cr")
    found = barcodes.within(some, some.withColumnRenamed("cr", "wl"), 2)
    assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
    assert sorted((r.cr, r.wl, r.ed) for r in found.collect()) == [("ACGTACGA", "ACGTACGA", 0), ("ACGTACGA", "ACGTACGT", 1), ("ACGTACGT", "ACGTACGA", 1), ("ACGTACGT", "ACGTACGT", 0)]
