"""Interval joins and depth against plain versions, on lengths of 1 to 10^8 bases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cytoframe.operators import intervals

SCHEMA = "chrom string, start long, end long, id long"


def made(g, n, top):
    out = []
    for i in range(n):
        start = g.randrange(top)
        out.append((g.choice(["c1", "c2"]), start, start + g.choice([0, 1, 7, 1023, 1024, 1025, 8192, 8193, 10**5, 10**7, 10**8]), i))
    return out


@pytest.mark.parametrize("seed, top", [(1, 20_000), (2, 3_000_000), (3, 10**9)])
def test_overlaps(spark, seed, top):
    g = random.Random(seed)
    a, b = made(g, 150, top), made(g, 150, top)
    b = [(c, s, e, -i) for c, s, e, i in b]
    met = intervals.overlaps(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA).withColumnRenamed("id", "id2"))
    want = Counter((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert Counter((r.id, r.id2) for r in met.collect()) == want and sum(want.values()) > 50
    first = {r.id: r.start2 for r in intervals.first_overlap(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), "id").collect()}
    assert first == {i: min(y[1] for y in b if (i, y[3]) in want) for i in {k[0] for k in want}}


@pytest.mark.parametrize("seed, top", [(6, 60), (7, 20_000), (8, 10**8)])
def test_counts_and_firsts_without_pairs(spark, seed, top, monkeypatch):
    """Counts, first starts and semi joins equal plain ones, also of intervals of no length, and form no pair."""
    g = random.Random(seed)
    a, b = made(g, 150, top), made(g, 150, top)
    if top == 60:
        a, b = ([(c, s, s + g.choice([0, 0, 1, 5]), i) for c, s, _, i in x] for x in (a, b))
    monkeypatch.setattr(intervals, "overlaps", None)
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    met = lambda x: [y[1] for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]]
    want = {x[3]: (len(m), min(m)) for x in a if (m := met(x))}
    for stretch in (max(top // 7, 3), 10**7):
        assert {r.id: (r.n, r.start2) for r in intervals.overlap_counts(da, db, stretch).collect()} == want
        assert {r.id: r.start2 for r in intervals.with_first_overlap(da, db, stretch).collect()} == {k: v[1] for k, v in want.items()}
    assert {r.id for r in intervals.overlapping(da, db).collect()} == set(want)


def test_rows_do_not_grow_with_length(spark):
    one = spark.createDataFrame([("c", 5, 5 + 10**k, k) for k in range(9)], SCHEMA)
    rows = {r.id: r.n for r in intervals._looked_up(one, list(range(len(intervals.WIDTHS))), above=False).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert max(rows.values()) <= 2 * len(intervals.WIDTHS)
    assert intervals._own(one).groupBy("id").count().agg(F.max("count")).first()[0] <= 2


def depth_of(rows):
    depth = Counter()
    for c, s, e, _ in rows:
        for x in range(s, e):
            depth[c, x] += 1
    return depth


@pytest.mark.parametrize("seed", [4, 5])
def test_depths(spark, seed):
    g = random.Random(seed)
    rows = [(g.choice(["c1", "c2"]), s := g.randrange(900), s + g.choice([0, 1, 3, 10, 40, 250]), i) for i in range(60)]
    df, depth = spark.createDataFrame(rows, SCHEMA), depth_of(rows)
    got = Counter()
    runs = sorted((r.chrom, r.start, r.end, r.depth) for r in intervals.depth_runs(df, stretch=37).collect())
    for c, s, e, n in runs:
        got.update({(c, x): n for x in range(s, e)})
    assert got == depth
    assert all(x[0] != y[0] or x[2] <= y[1] for x, y in zip(runs, runs[1:], strict=False))
    for width, stretch in ((10, 3), (100, 10_000)):
        windows = {(r.chrom, r.start): (r.depth, r.end) for r in intervals.window_depth(df, width, stretch).collect()}
        want = Counter()
        for (c, x), n in depth.items():
            want[c, x // width * width] += n
        assert {k: round(v[0] * width) for k, v in windows.items()} == want and all(v[1] == k[1] + width for k, v in windows.items())
    targets = [("c1", 0, 50, 1), ("c1", 40, 41, 2), ("c2", 500, 1200, 3), ("c3", 0, 10, 4), ("c1", 9, 9, 5)]
    means = {r.id: r.depth for r in intervals.target_depth(df, spark.createDataFrame(targets, SCHEMA)).collect()}
    for c, s, e, i in targets:
        assert means[i] == (None if s == e else pytest.approx(sum(depth[c, x] for x in range(s, e)) / (e - s)))


def test_a_long_interval_and_clamped_ends(spark):
    long = spark.createDataFrame([("c", 0, 10**6, 1), ("c", 10, 20, 2)], SCHEMA)
    got = intervals.window_depth(long, 1000).agg(F.count("*").alias("n"), F.sum("depth").alias("d")).first()
    assert got.n == 1000 and round(got.d, 6) == 1000.01
    lengths = spark.createDataFrame([("c", 30)], "chrom string, length long")
    small = spark.createDataFrame([("c", 10, 20, 1), ("c", 28, 29, 2)], SCHEMA)
    assert [(r.start, r.end) for r in intervals.merged(small, 15, lengths=lengths).collect()] == [(0, 30)]
    with pytest.raises(Exception, match="without a length"):
        intervals.merged(small.withColumn("chrom", F.lit("x")), 15, lengths=lengths).collect()
    assert intervals.deepest_locus(spark.createDataFrame([("c", 5, 9, 2.0), ("c", 1, 4, 2.0)], "chrom string, start long, end long, depth double"), 50, lengths).first().locus == "c:0-30"
