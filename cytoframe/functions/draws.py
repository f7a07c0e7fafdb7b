"""Binomial draws that a hash fixes: the same entry gives the same draw whenever and wherever a task runs.

A draw costs a few steps whatever its count. Where few successes are expected, one uniform number is inverted through the distribution;
else numbers are proposed from a curve that lies above it and taken or not by the exact ratio (transformed rejection), with further
uniforms from the same hash for each try. Both are exact up to rounding. Nested samples come from conditional draws, from the largest
share down: of what a share keeps, the next keeps as many as the ratio of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

U64 = np.uint64
FEW = 10.0  # expected successes up to which a draw is inverted

#: How far Stirling's formula is from the logarithm of k!, for k of 0 to 9.
STIRLING = np.array([0.0810614667953272, 0.0413406959554092, 0.0276779256849983, 0.0207906721037650, 0.0166446911898211, 0.0138761288230707, 0.0118967099458917, 0.0104112652619720, 0.00925546218271273, 0.00833056343336287])


def uniforms(key: np.ndarray, salt: int) -> np.ndarray:
    """Numbers between 0 and 1, neither included, that 64-bit keys and a salt fix (splitmix64's finaliser)."""
    x = key.astype(U64) + U64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return ((x >> U64(12)).astype(np.float64) + 0.5) / 2.0**52


def _tail(k: np.ndarray) -> np.ndarray:
    """Logarithm of k! less Stirling's formula."""
    m = k + 1.0
    far = (1 / 12 - (1 / 360 - 1 / 1260 / m**2) / m**2) / m
    return np.where(k < 10, STIRLING[np.clip(k, 0, 9).astype(np.int64)], far)


def _inverted(n: np.ndarray, p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The smallest k whose cumulated probability reaches u, walking up from 0; for n p of some ten at most."""
    k, live = np.zeros(len(n), np.int64), np.arange(len(n))
    mass = np.exp(n * np.log1p(-p))
    left = u - mass
    while len(live := live[(left[live] > 0) & (k[live] < n[live])]):
        k[live] += 1
        mass[live] *= (n[live] - k[live] + 1) / k[live] * (p[live] / (1 - p[live]))
        left[live] -= mass[live]
        live = live[mass[live] > 0]  # beyond the smallest number there is, k stays
    return k


def _rejected(n: np.ndarray, p: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Transformed rejection for p up to a half and n p of ten or more."""
    spread = np.sqrt(n * p * (1 - p))
    b = 1.15 + 2.53 * spread
    a = -0.0873 + 0.0248 * b + 0.01 * p
    c, steep = n * p + 0.5, 0.92 - 4.2 / b
    alpha, odds, mode = (2.83 + 5.1 / b) * spread, p / (1 - p), np.floor((n + 1) * p)
    out, live, turn = np.zeros(len(n), np.int64), np.arange(len(n)), 0
    while len(live):
        i = live
        u, v = uniforms(key[i], 2 * turn + 1) - 0.5, uniforms(key[i], 2 * turn + 2)
        us = 0.5 - np.abs(u)
        k = np.floor((2 * a[i] / us + b[i]) * u + c[i])
        inside = (k >= 0) & (k <= n[i])
        k = np.clip(k, 0, n[i])
        sure = inside & (us >= 0.07) & (v <= steep[i])
        m, nn = mode[i], n[i]
        top = (m + 0.5) * np.log((m + 1) / (odds[i] * (nn - m + 1))) + (nn + 1) * np.log((nn - m + 1) / (nn - k + 1)) + (k + 0.5) * np.log(odds[i] * (nn - k + 1) / (k + 1))
        top += _tail(m) + _tail(nn - m) - _tail(k) - _tail(nn - k)
        taken = sure | (inside & (np.log(v * alpha[i] / (a[i] / us**2 + b[i])) <= top))
        out[i[taken]] = k[taken].astype(np.int64)
        live, turn = i[~taken], turn + 1
    return out


def binomial(n: np.ndarray, p: np.ndarray | float, key: np.ndarray) -> np.ndarray:
    """One draw for each count n with its chance p, fixed by its 64-bit key. Counts up to 2^52."""
    n = np.asarray(n, np.int64)
    p = np.broadcast_to(np.asarray(p, np.float64), n.shape)
    key = np.asarray(key).astype(np.int64).view(U64)
    out = np.where(p >= 1, n, 0)
    mirrored = p > 0.5
    q = np.where(mirrored, 1 - p, p)
    open_ = (n > 0) & (p > 0) & (p < 1)
    few = open_ & (n * q < FEW)
    many = open_ & ~few
    draw = np.zeros(len(n), np.int64)
    draw[few] = _inverted(n[few], q[few], uniforms(key[few], 0))
    draw[many] = _rejected(n[many].astype(np.float64), q[many], key[many])
    return np.where(open_, np.where(mirrored, n - draw, draw), out)


def nested(n: np.ndarray, shares: Sequence[float], key: np.ndarray) -> list[np.ndarray]:
    """Draws for several shares of the same counts, each among those of every larger share; in the order of shares."""
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(shares)
    held, before = np.asarray(n, np.int64), 1.0
    for i in sorted(range(len(shares)), key=lambda i: -shares[i]):
        ratio = min(1.0, shares[i] / before) if before > 0 else 0.0
        held = binomial(held, ratio, (uniforms(np.asarray(key).astype(np.int64).view(U64), 1_000 + int(shares[i] * 2**40)) * 2.0**52).astype(np.int64))
        out[i], before = held, shares[i]
    return out


def thinned(value: Column, key: Column, shares: Sequence[float]) -> Column:
    """Nested draws of a whole count for several shares, as an array of longs; key: a 64-bit hash that tells entries apart."""
    shares = list(shares)

    @F.pandas_udf("array<long>")
    def run(n: pd.Series, k: pd.Series) -> pd.Series:
        columns = nested(n.to_numpy(np.int64), shares, k.to_numpy(np.int64))
        return pd.Series(list(np.stack(columns, 1)) if len(n) else [], index=n.index, dtype=object)

    return run(value.cast("long"), key)
