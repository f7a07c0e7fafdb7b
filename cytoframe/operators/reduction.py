"""Principal components of a matrix, by products that stay distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.operators.matrix import Matrix
from cytoframe.sources.scratch import written

NAME_BYTES = 40  # of a row of weights, beside its numbers
SENT = 8 << 20  # bytes of weights up to which Spark chooses the join; it sends about so many to every task


def _product(values: DataFrame, by: str, other: str, weights: DataFrame, k: int) -> DataFrame:
    """Rows (by, w array<double>): the matrix times the weights of the other axis, a written table.

    Weights too long to be sent to every task are dealt and hashed, so a task sorts no values and holds its share of the axis.
    """
    if weights.count() * (8 * k + NAME_BYTES) > SENT:
        weights = weights.hint("shuffle_hash")
    each = [F.sum(F.col("value") * F.col("w")[i]) for i in range(k)]
    return values.join(weights, other).groupBy(by).agg(F.array(*each).alias("w"))


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _gram(table: DataFrame, k: int) -> np.ndarray:
    """k x k products of the columns of w; the sums of each task are added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            w = _rows(batch.column(0))
            total += w.T @ w if len(w) else 0
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total.reshape(-1))], names=["at", "v"])

    found = table.select("w").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    g = np.zeros(k * k)
    for r in found:
        g[r["at"]] = r["v"]
    return g.reshape(k, k)


def _turned(table: DataFrame, by: str, m: np.ndarray) -> DataFrame:
    """w times a small matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _rows(batch.column(1)) @ m if batch.num_rows else np.zeros((0, m.shape[1]))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * m.shape[1], pa.int32()), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[by, "w"])

    return table.select(by, "w").mapInArrow(run, f"{by} string, w array<double>")


def _orthogonal(table: DataFrame, by: str, k: int) -> DataFrame:
    """The same column space with orthonormal columns; columns that depend on others become zero."""
    value, axes = np.linalg.eigh(_gram(table, k))
    scale = np.where(value > 1e-12 * max(value.max(), 1e-300), 1 / np.sqrt(np.maximum(value, 1e-300)), 0)
    return written(_turned(table, by, axes * scale), "basis")


def components(matrix: Matrix, k: int, *, rounds: int = 4, extra: int = 5) -> DataFrame:
    """Rows (cell, pca_0 .. pca_k-1): the cells along the k largest singular directions of the matrix (not centred, as it is sparse).

    Subspace iteration from a fixed pseudo-random start: each round is two joins with small aggregates; of the matrix nothing is collected
    but the products of `k + extra` columns. Cells of zeros are 0. The sign of a component is that which makes its largest weight positive.
    """
    m = k + extra
    values = matrix.values
    start = F.array(*[F.xxhash64("feature", F.lit(i)) / float(1 << 62) for i in range(m)])
    basis = _orthogonal(matrix.features.select("feature", start.alias("w")), "feature", m)
    for _ in range(rounds):
        by_cell = written(_product(values, "cell", "feature", basis, m), "product")
        basis = _orthogonal(_product(values, "feature", "cell", by_cell, m), "feature", m)
    by_cell = written(_product(values, "cell", "feature", basis, m), "product")
    value, axes = np.linalg.eigh(_gram(by_cell, m))
    axes = axes[:, np.argsort(-value)[:k]]
    weights = _turned(basis, "feature", axes)
    top = weights.agg(*[F.max_by(F.col("w")[i], F.struct(F.abs(F.col("w")[i]), "feature")).alias(f"_{i}") for i in range(k)]).first()
    signs = np.array([-1.0 if (top[f"_{i}"] or 0) < 0 else 1.0 for i in range(k)])
    out = _turned(by_cell, "cell", axes * signs)
    named = out.select("cell", *[F.col("w")[i].alias(f"pca_{i}") for i in range(k)])
    return matrix.cells.join(named, "cell", "left").na.fill(0.0)
