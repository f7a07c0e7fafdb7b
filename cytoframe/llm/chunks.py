"""Substring deduplication by content-defined chunks.

A gear hash rolls over the last GEAR bytes; a chunk ends where it falls below a bound, about every MEAN bytes, so an insertion
shifts no boundary but its own; ends inside a character move behind it. Chunks are deduplicated by a 128-bit digest: all but the first occurrence in (doc_id, position)
order go, if they lie in a stretch of consecutive repeated chunks of at least MIN_RUN bytes, so short common phrases stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.hashing import BYTE, U64, mix, span_hashes
from cytoframe.llm.shared import in_slots, packed, repeated_slots, slices, written

GEAR, MEAN, LEAST, MOST = 16, 40, 12, 1024
MIN_RUN = 80
_GEAR = (mix(np.arange(1001, 1257, dtype=U64)) >> U64(32)).astype(np.uint32)
_SECOND = mix(BYTE + U64(17))


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of packed texts, ascending; every text's end is one. Where chunks end in a text depends on that text alone."""
    n = len(data)
    h = _GEAR[data]
    size = 1
    while size < GEAR:
        more = h.copy()
        more[size:] += h[:-size] << np.uint32(size)
        h, size = more, 2 * size
    # the lowest GEAR bits of the sum are full: bit k holds the last k + 1 bytes
    at = np.flatnonzero((h << np.uint32(32 - GEAR)) < np.uint32((1 << 32) // MEAN)) + 1
    text = np.searchsorted(offsets, at - 1, side="right") - 1
    at = at[at - offsets[text] >= GEAR]
    near = np.zeros(len(at), bool)
    near[1:] = at[1:] - at[:-1] < LEAST
    ends = np.unique(np.concatenate([at[~near], offsets[1:][np.diff(offsets) > 0]]))
    starts = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - starts > MOST)
    if len(long):
        extra = [np.arange(starts[i] + MOST, ends[i], MOST) for i in long]
        ends = np.unique(np.concatenate([ends, *extra]))
    for _ in range(3):  # not inside a character
        inside = (ends < n) & ((data[np.minimum(ends, max(n - 1, 0))] & 0xC0) == 0x80)
        ends = np.unique(ends + inside)
    return ends if n else np.zeros(0, np.int64)


def chunked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, texts and the two halves of the digests of all chunks."""
    ends = boundaries(data, offsets)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    text = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, text, span_hashes(BYTE[data], starts, ends), span_hashes(_SECOND[data], starts, ends)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            h = chunked(*packed(part.column(0)))[3]
            value, times = np.unique(h, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)], names=["_h", "_n"])


def _occurrences(cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                data, offsets = packed(part.column(2))
                starts, ends, text, h, g = chunked(data, offsets)
                p = np.flatnonzero(in_slots(cells.value, h))
                t = pa.array(text[p])
                yield pa.RecordBatch.from_arrays([pa.array(h[p].view(np.int64)), pa.array(g[p].view(np.int64)), part.column(0).take(t), part.column(1).take(t), pa.array(starts[p] - offsets[text[p]]), pa.array(ends[p] - offsets[text[p]])], names=["_h", "_g", "_doc", "_t", "_from", "_to"])

    return run


def stretches(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For chunks in order, the bytes of the stretch of adjoining chunks that each lies in."""
    if not len(start):
        return np.zeros(0, np.int64)
    head = np.concatenate([[True], start[1:] != end[:-1]])
    run = np.cumsum(head) - 1
    return np.bincount(run, end - start).astype(np.int64)[run]


def dedup_chunks(docs: DataFrame, *, min_run: int = MIN_RUN) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_repeated (bytes in long stretches of repeated chunks), n_removed, copies_of, kept_sha256, kept.

    copies_of lists the documents whose first occurrences the removed chunks repeat, ascending. Null texts count as empty; rows whose id is null lose
    nothing and take nothing from others. Rows of one id and text count as occurrences of one place, so repeated rows stay alike.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_t"), F.col("text").alias("_text"))
    sound = texts.where("_doc is not null and _text is not null")
    often = sound.select("_text").mapInArrow(_digests, "_h long, _n long").groupBy("_h").agg(F.sum("_n").alias("_n")).where("_n > 1")
    cells = repeated_slots(often, "_h")
    seen = written(sound.mapInArrow(_occurrences(cells), "_h long, _g long, _doc long, _t long, _from long, _to long"), "chunks")
    place = F.struct("_doc", "_from")
    first = seen.groupBy("_h", "_g").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first != _last").select("_h", "_g", F.col("_first._doc").alias("_source"), F.col("_first._from").alias("_source_from"))
    repeated = written(seen.join(first, ["_h", "_g"]).select("_doc", "_t", "_from", "_to", "_source", ((F.col("_doc") != F.col("_source")) | (F.col("_from") != F.col("_source_from"))).alias("_later")), "repeated")
    each = repeated.groupBy("_doc", "_t").agg(F.array_sort(F.collect_set(F.struct("_from", "_to", "_later", "_source"))).alias("_chunks"))
    fields = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_bytes long, n_repeated long, n_removed long, copies_of array<long>, kept_sha256 string, kept string").fields])
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                data, offsets = packed(part.column(1))
                raw = data.tobytes()
                found = part.column(2)
                to = np.concatenate([[0], np.cumsum(np.asarray(found.value_lengths().fill_null(0)))]).astype(np.int64)
                flat = found.flatten()
                a, b, source = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("_from", "_to", "_source"))
                later = flat.field("_later").to_numpy(zero_copy_only=False).astype(bool)
                rows = []
                for i in range(part.num_rows):
                    own, s = raw[offsets[i] : offsets[i + 1]], slice(to[i], to[i + 1])
                    in_run = stretches(a[s], b[s]) >= min_run
                    gone = np.flatnonzero(in_run & later[s]) + to[i]
                    keep, at = [], 0
                    for k in gone.tolist():
                        keep.append(own[at : a[k]])
                        at = b[k]
                    kept = b"".join([*keep, own[at:]]) if len(gone) else own
                    rows.append((len(own), int((b[s] - a[s])[in_run].sum()), len(own) - len(kept), np.unique(source[gone]).tolist(), hashlib.sha256(kept).hexdigest(), kept.decode()))
                cols = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

    rows = docs.select("doc_id", F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_t"), F.col("text").alias("_text"))
    return rows.join(each, ["_doc", "_t"], "left").select("doc_id", "_text", "_chunks").mapInArrow(run, fields)
