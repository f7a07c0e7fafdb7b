"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are turned into their principal axes, so that the leading dimensions hold most of their length, and sorted into tiles by
cells of the first axes. Two tiles are compared unless their bounding boxes are too far apart for the threshold. What the axes after
the leading ones can add to a cosine is at most the product of the two norms there. That norm is taken as one more axis, so that one
matrix product in single precision bounds the cosines of many pairs at once; its rounding is allowed for. Pairs that it cannot give up
are decided by the cosine of the original vectors in double precision, or, where they are many, by a product of all axes first, which
leaves only those to double precision that lie within its rounding of the threshold. Vectors are scaled by a power of two first, which
changes no cosine, so that no square overflows or vanishes. Tiles move in blocks, once for each pair of blocks that holds a pair of near
tiles; blocks grow with the rows, so that their number and with it what is moved does not, until they are full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm.components import connected_components
from cytoframe.llm.shared import partitions, trim, written

COSINE = 0.9
TILE = 1024  # vectors a tile at most
BLOCKS = 16  # blocks are to be so many, of TILE vectors at least
BLOCK, NUMBERS = 1 << 16, 1 << 22  # vectors and components a block at most; a tile is never cut
PARTS = 4096  # tasks that pairs of blocks are dealt to at most
CELL, CELL_AXES, BOX_AXES = 0.45, 3, 16
HEAD = 32  # leading axes of the first product
ROWS, COLS = 512, 1024  # rows and columns of one product
DENSE = 1 / 32  # share of pairs to decide beyond which all axes are multiplied, and of links beyond which they are kept as marks
EDGES = 1 << 18  # links that are held before they are joined


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component between a half and one."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the products of the components of all unit vectors of a partition: one row for each component."""
    total = None
    for batch in batches:
        if batch.num_rows:
            x = scaled(matrix(batch.column(0)))
            x /= np.sqrt((x * x).sum(1, keepdims=True))
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        d = len(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(d), d), pa.int32()), pa.array(np.tile(np.arange(d), d), pa.int32()), pa.array(total.reshape(-1))], names=["_i", "_j", "_s"])


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """Orthogonal matrix whose columns are the principal axes about the origin, largest first; from sums over all rows, d * d of which reach the driver."""
    rows = vectors.select("_x").mapInArrow(_moments, "_i int, _j int, _s double").groupBy("_i", "_j").agg(F.sum("_s").alias("_s")).collect()
    m = np.zeros((d, d))
    for r in rows:
        m[r["_i"], r["_j"]] = r["_s"]
    value, axes = np.linalg.eigh((m + m.T) / 2)
    return axes[:, np.argsort(-value)]


def _place(axes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = scaled(matrix(batch.column(1)))
            y = (x / np.sqrt((x * x).sum(1, keepdims=True))) @ axes.value
            cell = np.floor(y[:, :CELL_AXES] / CELL).astype(np.int64)
            cell = np.pad(cell, ((0, 0), (0, CELL_AXES - cell.shape[1])))
            key = ((cell[:, 0] + 8) * 16 + cell[:, 1] + 8) * 16 + cell[:, 2] + 8
            raw = x.tobytes()
            step = 8 * x.shape[1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key, pa.int32()), pa.array(y[:, 0]), pa.array([raw[i * step : (i + 1) * step] for i in range(len(x))], pa.binary())], names=["_rep", "_cell", "_first", "_raw"])

    return run


def narrow(x: np.ndarray) -> np.ndarray:
    """x in single precision where that loses nothing."""
    y = x.astype(np.float32)
    return y if (y == x).all() else x


def widened(raw: bytes, d: int, n: int) -> np.ndarray:
    """The n rows of narrow(x).tobytes(), as narrow as they are."""
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * d * n else np.float64).reshape(n, d)


def _tile(axes):
    """Consecutive rows of a partition as tiles: ids, raw vectors, the box of the leading axes, and the rows before it. A tile ends with its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = before = 0
        held: list = []
        cell = None

        def flush() -> pa.RecordBatch:
            nonlocal number, before
            ids = np.array([h[0] for h in held], np.int64)
            x = np.frombuffer(b"".join(h[1] for h in held), np.float64).reshape(len(ids), -1)
            y = ((x / np.sqrt((x * x).sum(1, keepdims=True))) @ axes.value)[:, :BOX_AXES]
            part = TaskContext.get().partitionId()
            row = [[part << 32 | number], [part], [before], [len(ids)], [ids.tobytes()], [narrow(x).tobytes()], [y.min(0).tolist()], [y.max(0).tolist()]]
            number += 1
            before += len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())), strict=True)], names=["_tile", "_part", "_before", "_n", "_ids", "_raw", "_low", "_high"])

        for batch in batches:
            for rep, c, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if held and (c != cell or len(held) >= TILE):
                    yield flush()
                cell = c
                held.append((rep, raw))
        if held:
            yield flush()

    return run


class Side:
    """Vectors of a block: as they are, their norms, and their turned unit vectors in single precision, with the norm of the rest after the leading axes."""

    def __init__(self, tiles: list[np.ndarray], axes: np.ndarray) -> None:
        d = len(axes)
        h = min(HEAD, d)
        n = sum(len(x) for x in tiles)
        self.x = np.concatenate(tiles)
        self.norm, self.unit, self.head = np.empty(n), np.empty((n, d), np.float32), np.empty((n, h + 1), np.float32)
        at = 0
        for x in tiles:
            x = x.astype(np.float64)
            to = at + len(x)
            self.norm[at:to] = np.sqrt((x * x).sum(1))
            u = (x / self.norm[at:to, None]) @ axes
            self.unit[at:to] = u
            self.head[at:to, :h] = u[:, :h]
            self.head[at:to, h] = np.sqrt((u[:, h:] ** 2).sum(1))
            at = to

    def take(self, rows: np.ndarray) -> Side:
        """Some of the rows, which are in ascending order; without a copy if they are one range."""
        if len(rows) and rows[-1] - rows[0] + 1 == len(rows):
            rows = slice(int(rows[0]), int(rows[-1]) + 1)
        out = object.__new__(Side)
        out.x, out.norm, out.unit, out.head = self.x[rows], self.norm[rows], self.unit[rows], self.head[rows]
        return out


def linked(one: Side, two: Side, a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Whether the cosine of each pair is at least the threshold, in double precision."""
    out = np.empty(len(a), bool)
    for k in range(0, len(a), 1 << 14):
        m, n = a[k : k + (1 << 14)], b[k : k + (1 << 14)]
        out[k : k + (1 << 14)] = np.einsum("ij,ij->i", one.x[m].astype(np.float64), two.x[n].astype(np.float64)) / (one.norm[m] * two.norm[n]) >= cosine
    return out


def close_pairs(one: Side, two: Side, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Index pairs of rows whose cosine is at least the threshold, those of one product at a time: (a, b, None), or rows, columns and which of their pairs where these are many."""
    d = one.unit.shape[1]
    slack = (d + 8) * 2.0**-23  # twice what d + 1 products and sums in single precision can be off, and more than rounding takes
    products, marks = np.empty(ROWS * COLS, np.float32), np.empty(ROWS * COLS + 8, bool)
    for i in range(0, len(one.x), ROWS):
        p = one.head[i : i + ROWS]
        for j in range(0, len(two.x), COLS):
            q = two.head[j : j + COLS]
            size, width = len(p) * len(q), len(q)
            s = np.matmul(p, q.T, out=products[:size].reshape(len(p), width))
            np.greater_equal(s, np.float32(cosine - slack), out=marks[:size].reshape(len(p), width))
            eights = -(-size // 8)
            marks[size : 8 * eights] = False
            many = np.count_nonzero(marks[:size])
            if not many:
                continue
            if many > DENSE * size:
                np.matmul(one.unit[i : i + ROWS], two.unit[j : j + COLS].T, out=s)
                sure = s >= np.float32(cosine + slack)
                doubt = (s >= np.float32(cosine - slack)) != sure
                if doubt.any():
                    a, b = np.nonzero(doubt)
                    sure[a, b] = linked(one, two, a + i, b + j, cosine)
                if np.count_nonzero(sure) > size * DENSE:
                    yield np.arange(i, i + len(p)), np.arange(j, j + width), sure
                    continue
                a, b = np.nonzero(sure)
            else:
                some = np.flatnonzero(marks[: 8 * eights].view(np.uint64))
                at = (some[:, None] * 8 + np.arange(8)).reshape(-1)
                a, b = np.divmod(at[marks[at]], width)
                ok = linked(one, two, a + i, b + j, cosine)
                a, b = a[ok], b[ok]
            if len(a):
                yield a + i, b + j, None


def join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins in place what the edges connect; label holds the smallest node of each node's component, before and after."""
    while True:
        p, q = label[a], label[b]
        apart = p != q
        if not apart.any():
            return
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while ((up := label[label]) != label).any():
            label[:] = up


class Links:
    """Links of the nodes, weighted by copies, and labels that tell which nodes they join."""

    def __init__(self, copies: np.ndarray) -> None:
        self.copies, self.links, self.label = copies, np.zeros(len(copies), np.int64), np.arange(len(copies))
        self.held: list = []
        self.many = 0

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links a[k] with b[k]."""
        for at, to in ((a, b), (b, a)):
            first = int(at.min())
            n = np.bincount(at - first, self.copies[to])
            self.links[first : first + len(n)] += n.astype(np.int64)
        apart = self.label[a] != self.label[b]
        self.held.append((a[apart], b[apart]))
        self.many += int(apart.sum())
        if self.many > EDGES:
            self.settle()

    def block(self, a: np.ndarray, b: np.ndarray, which: np.ndarray) -> None:
        """Links a[i] with b[j] where which[i, j]; of a, and of b, no node occurs twice."""
        n = which.astype(np.float64)
        self.links[a] += (n @ self.copies[b]).astype(np.int64)
        self.links[b] += (self.copies[a] @ n).astype(np.int64)
        rows, cols = np.flatnonzero(which.any(1)), np.flatnonzero(which.any(0))
        p, q = self.label[a[rows]], self.label[b[cols]]
        if len(p) and (p == p[0]).all() and (q == p[0]).all():
            return
        join(self.label, np.concatenate([a[rows], a[which[:, cols].argmax(0)]]), np.concatenate([b[which[rows].argmax(1)], b[cols]]))
        i, j = np.nonzero(which & (self.label[a][:, None] != self.label[b]))
        join(self.label, a[i], b[j])

    def settle(self) -> None:
        if self.held:
            join(self.label, *(np.concatenate(h) for h in zip(*self.held, strict=True)))
        self.held, self.many = [], 0


def boxes_apart(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray) -> np.ndarray:
    """Squared distance of each pair of boxes."""
    gap = np.maximum(np.maximum(low[:, None] - high2[None], low2[None] - high[:, None]), 0)
    return (gap * gap).sum(2)


def _compare(axes, cosine: float, limit: float):
    """Link counts (kind 0: id, links weighted by copies) and a spanning forest of the links (kind 1) of each pair of blocks."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_side", "ascending"), ("_tile", "ascending")])
        side, sizes = group.column("_side").to_numpy(), group.column("_n").to_numpy()
        low, high = (np.array(group.column(c).to_pylist()) for c in ("_low", "_high"))
        own = side.max() == 0  # one block with itself
        d = len(axes.value)
        names = np.concatenate([np.frombuffer(r.as_buffer(), np.int64) for r in group.column("_ids")]).reshape(-1, 2)
        ids, copies = names[:, 0], names[:, 1]
        raw = [widened(r.as_buffer(), d, n) for r, n in zip(group.column("_raw"), sizes, strict=True)]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == side.max())
        one = Side([raw[i] for i in left], axes.value)
        two, shift = (one, 0) if own else (Side([raw[i] for i in right], axes.value), int(starts[right[0]]))
        near = boxes_apart(low[left], high[left], low[right], high[right]) <= limit
        found = Links(copies)
        for i in left:
            meets = right[near[i]]
            meets = meets[meets >= i] if own else meets  # one block with itself: each pair once
            if not len(meets):
                continue
            mine = np.arange(starts[i], ends[i])
            others = np.concatenate([np.arange(starts[j], ends[j]) for j in meets])
            for a, b, which in close_pairs(one.take(mine), two.take(others - shift), cosine):
                a, b = mine[a], others[b]
                if which is not None:
                    found.block(a, b, which & (b > a[:, None]) if own and b[0] <= a[-1] else which)
                    continue
                if own:
                    a, b = a[b > a], b[b > a]
                if len(a):
                    found.pairs(a, b)
        found.settle()
        links, label = found.links, found.label
        some, child = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
        out = pa.table({"_kind": pa.array(np.repeat([0, 1], [len(some), len(child)]), pa.int32()), "a": pa.array(np.concatenate([ids[some], ids[child]])), "b": pa.array(np.concatenate([links[some], ids[label[child]]]))})
        del group, names, raw, one, two
        trim()
        return out

    return run


def near_vectors(embeddings: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """One row per row of embeddings: vec_id, n_links (other vectors of cosine >= the threshold), component_id (smallest vec_id reachable), kept.

    Vectors that are null, zero, of another length than most or hold null or non-finite components link with nothing; so do rows
    whose vec_id is null (null component, not kept). Equal vectors are compared once and count as often as they occur.
    """
    spark: SparkSession = embeddings.sparkSession
    x = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("_id"), F.when(F.coalesce(sound, F.lit(False)), x).alias("_x"))
    common = rows.where("_x is not null").groupBy(F.size("_x").alias("_d")).count().orderBy(F.desc("count"), "_d").first()
    d = common["_d"] if common else 0
    rows = rows.withColumn("_same", F.when((F.size("_x") == d) & F.col("_id").isNotNull(), F.sha2(F.array_join(F.transform("_x", lambda v: (v + 0.0).cast("string")), ",").cast("binary"), 256)))
    reps = written(rows.where("_same is not null").groupBy("_same").agg(F.min(F.struct("_id", "_x")).alias("_r"), F.count("*").alias("_copies")).select("_same", F.col("_r._id").alias("_rep"), F.col("_r._x").alias("_x"), "_copies"), "vectors")
    axes = spark.sparkContext.broadcast(principal_axes(reps, d))
    count = reps.count()
    most = max(TILE, min(BLOCK, NUMBERS // max(d, 1)))
    n = max(1, min(max(partitions(embeddings), -(-count // (2 * most))), -(-count // (4 * TILE))))
    placed = written(reps.select(F.array("_rep", "_copies").alias("_rep"), "_x").mapInArrow(_place(axes), "_rep array<long>, _cell int, _first double, _raw binary"), "placed")
    tiles = placed.repartitionByRange(n, "_cell", "_first").sortWithinPartitions("_cell", "_first", "_rep")
    tiles = tiles.mapInArrow(_tile(axes), "_tile long, _part int, _before long, _n long, _ids binary, _raw binary, _low array<double>, _high array<double>")
    tiles = written(tiles, "tiles")
    # blocks are stretches of the order of all tiles: one small row a partition tells how many rows come before it
    sizes = tiles.groupBy("_part").agg(F.sum("_n").alias("_m"))
    sizes = sizes.select("_part", (F.sum("_m").over(Window.orderBy("_part")) - F.col("_m")).alias("_base"))
    full = max(TILE, min(most, -(-count // BLOCKS)))
    tiles = tiles.join(F.broadcast(sizes), "_part").withColumn("_block", F.floor((F.col("_base") + F.col("_before")) / full).cast("int")).drop("_part", "_base", "_before")
    box = tiles.select("_tile", "_block", "_low", "_high")
    # tiles meet in the cells of the first axes that their boxes, widened by the largest distance, cover
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    cells = lambda k, wide: F.explode(F.sequence(F.floor((F.element_at("_low", k) - wide) / CELL), F.floor((F.element_at("_high", k) + wide) / CELL)))
    near = lambda wide: box.withColumn("_c1", cells(1, wide)).withColumn("_c2", cells(min(2, max(d, 1)), wide)).select("_tile", "_block", "_c1", "_c2", "_low", "_high")
    other = near(0.0).select(F.col("_tile").alias("_tile2"), F.col("_block").alias("_block2"), "_c1", "_c2", F.col("_low").alias("_low2"), F.col("_high").alias("_high2"))
    gap = F.zip_with(F.zip_with("_low", "_high2", lambda a, b: F.greatest(a - b, F.lit(0.0))), F.zip_with("_low2", "_high", lambda a, b: F.greatest(a - b, F.lit(0.0))), lambda a, b: F.greatest(a, b))
    apart = F.aggregate(F.transform(gap, lambda g: g * g), F.lit(0.0), lambda s, g: s + g)
    limit = reach * reach + 1e-6
    pairs = near(reach).join(other, ["_c1", "_c2"]).where("_tile <= _tile2").where(apart <= limit)
    blocks = written(pairs.select(F.col("_block").alias("_b1"), F.col("_block2").alias("_b2")).distinct(), "blocks")
    sides = F.explode(F.when(F.col("_b1") == F.col("_b2"), F.array(F.struct(F.lit(0).alias("_side"), F.col("_b1").alias("_block")))).otherwise(F.array(F.struct(F.lit(0).alias("_side"), F.col("_b1").alias("_block")), F.struct(F.lit(1).alias("_side"), F.col("_b2").alias("_block")))))
    sent = blocks.select("_b1", "_b2", sides.alias("_x")).select("_b1", "_b2", "_x.*")
    both = sent.join(tiles, "_block").select("_b1", "_b2", "_side", "_tile", "_n", "_low", "_high", "_ids", "_raw")
    both = both.repartition(max(1, min(PARTS, blocks.count())), "_b1", "_b2")
    found = written(both.groupBy("_b1", "_b2").applyInArrow(_compare(axes, cosine, limit), "_kind int, a long, b long"), "links")
    counts = found.where("_kind = 0").groupBy(F.col("a").alias("_rep")).agg(F.sum("b").alias("_links"))
    parts = connected_components(found.where("_kind = 1"))
    known = reps.select("_same", "_rep", "_copies").join(counts, "_rep", "left").join(parts.withColumnRenamed("node", "_rep"), "_rep", "left")
    known = known.select("_same", (F.coalesce("_links", F.lit(0)) + F.col("_copies") - 1).alias("_links"), F.coalesce("component", "_rep").alias("_part"))
    out = rows.select("_id", "_same").join(known, "_same", "left")
    part = F.coalesce("_part", "_id")
    return out.select(F.col("_id").alias("vec_id"), F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), part.alias("component_id"), F.coalesce(F.col("_id") == part, F.lit(False)).alias("kept"))
