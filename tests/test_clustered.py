"""Clustered tables: no exchange in joins and groupings on their keys; repeated ids meet in order."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import tagging
from cytoframe.sources import clustered


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_exchange(spark, shuffled_joins):
    k = F.col("id")
    rows = spark.range(3000).select(k.alias("read_id"), F.concat(F.lit("chr"), k % 3).alias("chr"), F.concat(F.lit("c"), k % 40).alias("CB"), (k % 7).cast("string").alias("UB"), F.when(k % 5 == 0, "-").otherwise("u").alias("UR"), F.when(k % 4 == 0, "-").otherwise(F.concat(F.lit("g"), k % 11)).alias("gene"), F.when(k % 10 == 1, k.cast("string")).otherwise("-").alias("SA"))
    names = [clustered.table_name("t") for _ in range(5)]
    tables = [clustered.write_clustered(rows.select("read_id", *c), n, *clustered.BY_READ, buckets=6) for n, c in zip(names, (["chr", "CB"], ["gene"], ["UB"]), strict=False)]
    joined = clustered.joined_by_read(*tables)
    assert joined.count() == 3000 and "Exchange" not in plan(joined)
    by_cell, split = clustered.write_tags(rows, names[3], names[4], buckets=6)
    totals = clustered.cell_totals(by_cell)
    assert "Exchange" not in plan(totals)
    known = rows.where("UR != '-'")
    assert totals.agg(F.sum("n_reads")).first()[0] == known.count() and split.count() == known.where("SA != '-'").count() > 0
    want = {(r.chr, r.CB): (r.u, r.g) for r in known.groupBy("chr", "CB").agg(F.countDistinct("UB").alias("u"), F.countDistinct(F.nullif("gene", F.lit("-"))).alias("g")).collect()}
    assert {(r.chr, r.CB): (r.n_umis, r.n_genes) for r in totals.collect()} == want
    for n in names:
        clustered.drop_clustered(spark, n)
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_kth_with_kth(spark):
    g = random.Random(3)
    left = [(g.choice("abcd" + "x" * 8), g.randint(0, 9)) for _ in range(120)]
    right = [(g.choice("abce" + "x" * 4), g.randint(0, 9), g.choice("pq")) for _ in range(90)]
    got = tagging.in_order(spark.createDataFrame(left, "read_id string, n int"), spark.createDataFrame(right, "read_id string, m int, s string"))
    one, two = defaultdict(list), defaultdict(list)
    for r in sorted(left):
        one[r[0]].append(r[1:])
    for r in sorted(right):
        two[r[0]].append(r[1:])
    want = sorted((k, *a, *b) for k in one for a, b in zip(one[k], two[k], strict=False))
    assert sorted(tuple(r) for r in got.collect()) == want
    assert got.columns == ["read_id", "n", "m", "s"]
    assert tagging.in_order(spark.createDataFrame([], "read_id string, n int"), spark.createDataFrame(right, "read_id string, m int, s string")).count() == 0
