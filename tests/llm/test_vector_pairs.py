"""Pairs of vectors cost little more than their product in single precision, and what is moved follows the rows, not the partitions."""

import time

import numpy as np
import pytest

from cytoframe.llm import embeddings


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def listed(found):
    """Index pairs of what close_pairs() gives."""
    return [p for a, b, which in found for p in (zip(a.tolist(), b.tolist(), strict=True) if which is None else [(int(a[i]), int(b[j])) for i, j in np.argwhere(which)])]


@pytest.mark.parametrize("d", [1, 6, 32, 33, 64, 200])
def test_pairs_equal_brute_force(d):
    """Lone pairs, large clusters, and cosines within the rounding of single precision of the threshold, on either side."""
    g = np.random.default_rng(d)
    x = g.normal(size=(900, d))
    x[:300] = g.normal(size=d) + 0.2 * g.normal(size=(300, d))
    if d > 1:
        along, across = unit(g.normal(size=(300, d))), unit(g.normal(size=(300, d)))
        across = unit(across - (across * along).sum(1, keepdims=True) * along)
        cosine = 0.9 + g.choice([-1, 1], 300) * 10.0 ** -g.uniform(7, 13, 300)
        x[300:600], x[600:] = along, cosine[:, None] * along + np.sqrt(1 - cosine**2)[:, None] * across
    axes = np.linalg.qr(g.normal(size=(d, d)))[0]
    side = embeddings.Side([x[:100], x[100:]], axes)
    found = listed(embeddings.close_pairs(side, side, 0.9))
    n = np.sqrt((x * x).sum(1))
    all_pairs = np.stack([np.einsum("ij,ij->i", np.broadcast_to(v, x.shape), x) for v in x]) / np.outer(n, n)
    want = set(zip(*(v.tolist() for v in np.nonzero(all_pairs >= 0.9)), strict=True))
    assert len(found) == len(set(found)) and set(found) == want
    assert d == 1 or 100 < sum((i, i + 300) in want for i in range(300, 600)) < 200


def test_pairs_cost_a_product():
    g = np.random.default_rng(1)
    side = embeddings.Side([g.normal(size=(8192, 64))], np.linalg.qr(g.normal(size=(64, 64)))[0])
    at = time.process_time()
    for i in range(0, 8192, 256):
        (side.unit[i : i + 256] @ side.unit.T).max()
    product = time.process_time() - at
    at = time.process_time()
    assert len(listed(embeddings.close_pairs(side, side, 0.9))) == 8192
    assert time.process_time() - at < 5 * product


def test_many_links_of_a_block():
    """Counts and components of links given as blocks, several clusters in one, are those of the same links given one by one."""
    g = np.random.default_rng(4)
    copies = g.integers(1, 5, 400)
    kind = g.integers(0, 6, 400)
    one, two = embeddings.Links(copies), embeddings.Links(copies)
    for a in range(0, 400, 100):
        for b in range(a, 400, 50):
            at, to = np.arange(a, a + 100), np.arange(b, b + 50)
            which = (kind[at][:, None] == kind[to]) & (g.random((100, 50)) < 0.3) & (to > at[:, None])
            one.block(at, to, which)
            i, j = np.nonzero(which)
            two.pairs(at[i], to[j])
    two.settle()
    assert (one.links == two.links).all() and (one.label == two.label).all() and len(set(one.label.tolist())) >= 6


def test_blocks_follow_the_rows(spark, monkeypatch):
    """With many shuffle partitions, tiles are as full as with few, blocks as few, and the links those of brute force."""
    kept, before = {}, spark.conf.get("spark.sql.shuffle.partitions")
    write = embeddings.written
    monkeypatch.setattr(embeddings, "written", lambda df, name, **k: kept.setdefault(name, write(df, name, **k)))
    g = np.random.default_rng(2)
    x = g.normal(size=(12_000, 24))
    x[6000:] = x[:6000] + 0.15 * g.normal(size=(6000, 24))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = {r.vec_id: r.n_links for r in embeddings.near_vectors(frame(spark, x)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    u = unit(x)
    want = (u @ u.T >= 0.9).sum(1) - 1
    assert got == dict(enumerate(want.tolist())) and want.sum() > 10_000
    assert kept["tiles"].count() < 64
