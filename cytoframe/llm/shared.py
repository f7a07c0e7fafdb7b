"""Shared folder, scratch tables and Arrow helpers used by the operators."""

from __future__ import annotations

import ctypes
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


BATCH_SIZE, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_BYTES, unless the session has set a size of its own: long texts would fill workers otherwise."""
    if spark.conf.get(BATCH_SIZE) == "67108864b":
        spark.conf.set(BATCH_SIZE, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables of a data folder."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a folder of the default file system; on a cluster whose default file system is local, an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        base = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        local = base.startswith("file:")
        if local and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "/tmp/cytoframe-shared" if local else f"{base.rstrip('/')}/tmp/cytoframe-shared"
    return folder


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it ends: for actions whose result is kept, so that nothing reads them again."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with own_shuffles(spark):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions(df: DataFrame) -> int:
    """Number of partitions for an explicit exchange: the session's setting, never fewer than the scan has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def fold(doc_id: str, mod: int):
    """crc32 of the decimal id, modulo mod."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array, one after the other, and int64 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]] if len(off) else raw[:0], (off - off[0] if len(off) else np.zeros(1, np.int64))


@cache
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def trim() -> None:
    """Gives freed memory back to the system, so that a Python worker that is used again does not keep its peak."""
    pa.default_memory_pool().release_unused()
    if (c := _libc()) is not None and hasattr(c, "malloc_trim"):
        c.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, size: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of about `size` text bytes each, so that working memory stays bounded; a row is never cut."""
    if not batch.num_rows:
        return
    _, off = packed(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    trim()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0]+1, ... of all ranges, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - ends + lengths, lengths)


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over existing bytes."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


#: Bits that a value may fall on at most (64 MB), and bits a value that the bitmap is folded to.
SLOTS, ROOM = 1 << 29, 24
SEGMENT = 1 << 15


def _segment(group: pa.Table) -> pa.Table:
    """The bits of one segment of the bitmap, compressed, and how many are set."""
    bits = np.zeros(SEGMENT, np.uint8)
    bits[group.column("_slot").to_numpy() % SEGMENT] = 1
    return pa.table({"_segment": group.column("_segment")[:1], "_bits": pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary()), "_n": pa.array([int(bits.sum())], pa.int64())})


def repeated_slots(values: DataFrame, column: str):
    """A broadcast bitmap with the slots of the given 64-bit hashes, as a filter that lets each of them pass.

    Its size follows the number of values, ROOM bits each, up to SLOTS bits (64 MB) for 22 million values and more; beyond some 300
    million it fills up and filters less, but never drops one. Segments of 4 KB are packed on the executors.
    """
    slots = values.select(F.pmod(F.col(column), F.lit(SLOTS)).cast("int").alias("_slot")).distinct().withColumn("_segment", F.expr(f"int(_slot div {SEGMENT})"))
    with own_shuffles(values.sparkSession):
        rows = slots.groupBy("_segment").applyInArrow(_segment, "_segment int, _bits binary, _n long").collect()
    size = 1 << 16
    while size < min(SLOTS, ROOM * sum(r["_n"] for r in rows)):
        size *= 2
    cells = np.zeros(size // 64, np.int64)
    view = cells.view(np.uint8)
    for r in rows:
        at = r["_segment"] * SEGMENT // 8 % len(view)
        view[at : at + SEGMENT // 8] |= np.frombuffer(zlib.decompress(r["_bits"]), np.uint8)
    return values.sparkSession.sparkContext.broadcast(cells)


def in_slots(cells: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the slot of each hash is set: true for every hash put in, and for a few others."""
    have, h = cells.view(np.uint64), hashes.astype(np.uint64, copy=False)
    slot = h & np.uint64(64 * len(have) - 1)
    return ((have[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as it takes to differ from all columns of df, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
