"""Deletion variants: near UMIs and barcodes are found as a comparison of all would, with few candidates."""

import random

import pytest
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators import barcodes, umi


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def changed(g, s, n):
    for _ in range(n):
        i = g.randrange(len(s) + 1)
        kind = g.choice("sid")
        s = s[:i] + (g.choice("ACGT") if kind != "d" else "") + s[i + (kind != "i") :]
    return s


def test_deletions(spark):
    got = spark.createDataFrame([("ABCA",), ("A",), ("",), ("AAAA",)], "s string").select("s", seq.deletions(F.col("s"), 2).alias("d")).collect()
    assert {r.s: set(r.d) for r in got} == {"ABCA": {"ABCA", "BCA", "ACA", "ABA", "ABC", "CA", "BA", "BC", "AA", "AC", "AB"}, "A": {"A", ""}, "": {""}, "AAAA": {"AAAA", "AAA", "AA"}}


@pytest.mark.parametrize("edits", [1, 2])
def test_near_umis_of_any_length(spark, edits):
    g = random.Random(edits)
    base = ["".join(g.choice("ACGT") for _ in range(g.choice([4, 9, 12, 12, 12]))) for _ in range(40)]
    own = sorted({changed(g, b, g.randint(0, 3)) for b in base for _ in range(4)} - {""})
    df = spark.createDataFrame([("g", "c", u, i + 1) for i, u in enumerate(own)], "gene string, cb string, ur string, n long")
    got = {(r.ur, r.ur2) for r in umi.near_pairs(df, edits=edits).collect()}
    assert got == {(a, b) for a in own for b in own if a != b and edit_distance(a, b) <= edits} and len(got) > 50


def test_a_large_group_has_few_candidates(spark):
    """20,000 random UMIs of one gene and cell: pairs that meet are a few for each, not a share of the square."""
    df = spark.range(20_000).select(F.lit("g").alias("gene"), F.lit("c").alias("cb"), F.substring(F.translate(F.md5(F.col("id").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 12).alias("ur"), F.lit(1).alias("n")).dropDuplicates(["ur"])
    keys = df.select("ur", F.explode(umi.variants(2)).alias("_p"))
    met = keys.join(keys.withColumnRenamed("ur", "ur2"), "_p").where("ur != ur2").count()
    assert met < 200 * 20_000  # by pieces of four bases some 24,000,000


@pytest.mark.parametrize("edits, margin", [(2, 2), (1, 2), (2, 1)])
def test_index_of_a_long_list(spark, monkeypatch, edits, margin):
    g = random.Random(edits * 10 + margin)
    listed = {"".join(g.choice("ACGT") for _ in range(16)) for _ in range(150)}
    listed |= {changed(g, b, g.randint(1, 4)) for b in list(listed)[:80]}
    reads = sorted({changed(g, b, g.randint(0, 4)) for b in listed for _ in range(3)} | {"A" * 16, "ACGT"})
    args = (spark.createDataFrame([(r,) for r in reads], "cr string"), spark.createDataFrame([(b,) for b in listed], "barcode string"))
    plain = {r.cr: (r.cb, r.reason) for r in barcodes.correct(*args, max_edits=edits, margin=margin, blocked=False, barcode_length=16).collect()}
    monkeypatch.setattr(barcodes, "FULL_LIST", 10)
    indexed = {r.cr: (r.cb, r.reason) for r in barcodes.correct(*args, max_edits=edits, margin=margin, blocked=False, barcode_length=16).collect()}
    assert indexed == plain and len({v[1] for v in plain.values()}) >= 4


@pytest.mark.parametrize("blocked", [True, False])
def test_a_list_of_some_thousands_is_indexed(spark, monkeypatch, blocked):
    """With and without k-mers the index gives what comparisons give, and no barcode meets the list one by one."""
    g = random.Random(7)
    listed = {"".join(g.choice("ACGT") for _ in range(16)) for _ in range(600)}
    listed |= {changed(g, b, g.randint(1, 4)) for b in sorted(listed)[:300]}
    reads = sorted({changed(g, b, g.randint(0, 4)) for b in sorted(listed)[:400] for _ in range(2)} | {"A" * 16, "ACG", "AC", ""})
    args = (spark.createDataFrame([(r,) for r in reads], "cr string"), spark.createDataFrame([(b,) for b in listed], "barcode string"))
    run = lambda length: {r.cr: (r.cb, r.reason) for r in barcodes.correct(*args, blocked=blocked, barcode_length=length).collect()}
    monkeypatch.setattr(barcodes, "FULL_LIST", 10_000)
    plain = run(16), run(None)
    monkeypatch.undo()
    monkeypatch.setattr(barcodes, "_candidates", lambda some, listed, blocked: some.where("length(cr) < 4").join(listed))
    assert (run(16), run(None)) == plain and len({v[1] for v in plain[0].values()}) >= 4
