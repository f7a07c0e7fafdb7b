"""Binomial draws: distribution, moments, nesting, repeatability and very large counts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cytoframe.functions import draws
from cytoframe.operators.matrix import Matrix


def mass(n, p):
    return np.array([math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(n + 1)])


@pytest.mark.parametrize("n, p", [(1, 0.3), (7, 0.5), (20, 0.04), (40, 0.9), (60, 0.25), (400, 0.03), (1000, 0.5), (1000, 0.93)])
def test_distribution(n, p):
    """Largest gap between the cumulated shares and the exact ones, over 200,000 draws: within four standard deviations of none."""
    number = 200_000
    got = draws.binomial(np.full(number, n), p, np.arange(number) * 7919 + n)
    gap = np.abs(np.cumsum(np.bincount(got, minlength=n + 1)) / number - np.cumsum(mass(n, p))).max()
    assert gap < 2 / math.sqrt(number)
    assert (got == draws.binomial(np.full(number, n), p, np.arange(number) * 7919 + n)).all()


@pytest.mark.parametrize("n", [10**5, 10**7, 10**9, 10**12])
@pytest.mark.parametrize("p", [1e-6, 0.1, 0.5, 0.8])
def test_large_counts(n, p):
    number = 20_000
    got = draws.binomial(np.full(number, n), p, np.arange(number))
    spread = math.sqrt(n * p * (1 - p))
    assert got.min() >= 0 and got.max() <= n
    assert abs(got.mean() - n * p) < 5 * spread / math.sqrt(number)
    assert abs(got.std() / spread - 1) < 0.04


def test_edges_and_nesting():
    n = np.array([0, 1, 5, 100, 10**6])
    assert draws.binomial(n, 0.0, np.arange(5)).tolist() == [0] * 5 and draws.binomial(n, 1.0, np.arange(5)).tolist() == n.tolist()
    shares = (0.1, 1.0, 0.5, 0.02, 0.9)
    many = np.repeat([3, 30, 3000, 10**9], 20_000)
    got = draws.nested(many, shares, np.arange(len(many)))
    order = sorted(range(len(shares)), key=lambda i: shares[i])
    assert all((got[i] <= got[j]).all() for i, j in zip(order, order[1:], strict=False)) and (got[1] == many).all()
    for share, g in zip(shares, got, strict=True):
        for k, size in enumerate((3, 30, 3000, 10**9)):
            own = g[k * 20_000 : (k + 1) * 20_000]
            spread = math.sqrt(size * share * (1 - share))
            assert abs(own.mean() - size * share) <= 5 * spread / math.sqrt(20_000)
            assert abs(own.var() - spread**2) <= 0.1 * spread**2


def test_matrix_of_very_large_counts(spark):
    values = spark.range(200).select(F.concat(F.lit("g"), F.col("id") % 20).alias("feature"), F.concat(F.lit("c"), F.floor(F.col("id") / 20)).alias("cell"), F.when(F.col("id") % 2 == 0, 1e9).otherwise(3.0).alias("value"))
    m = Matrix.from_values(values)
    half = m.downsample(0.5)
    assert abs(half.values.where("value > 100").agg(F.avg("value")).first()[0] / 5e8 - 1) < 1e-4
    assert half.values.dtypes == m.values.dtypes
    first, again = ({(r.feature, r.cell): r.value for r in x.values.repartition(7).collect()} for x in (half, m.downsample(0.5)))
    assert first == again
    rows = m.saturation_statistics((0.1, 0.5, 1.0)).orderBy("frac").collect()
    assert [r.n_umis for r in rows] == sorted(r.n_umis for r in rows) and rows[2].n_umis == 100 * 10**9 + 300
    assert all(x.median_feats <= y.median_feats for x, y in zip(rows, rows[1:], strict=False)) and rows[2].median_feats == 20
