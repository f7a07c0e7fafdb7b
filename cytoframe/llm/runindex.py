"""Exact removal of repeated 200-byte strings with a run-length index.

Every 200-byte window is assigned to its smallest 64-byte hash (its anchor), so equal windows have equal anchors. Consecutive
windows of one anchor form a context. Contexts that occur twice are repeated throughout; the distinct contexts of an anchor go to
one bucket, where a run-length Burrows-Wheeler transform is built over them: at both ends of each run of equal symbols the suffix
position is sampled with its common prefix with the neighbouring suffix. Streaming through the text, the length of the longest match
elsewhere falls by one from place to place except at samples, so the samples give all matching statistics, and windows of 200 or more
are marked. An anchor with more than MANY distinct contexts would overload a bucket: its contexts are cut again by longer anchors, which
fewer of them share, and indexed by those. The longest anchor is the window itself: all windows of such a context are the same string (a
run of one byte gives several), and what counts is how many windows there are of each.
Contexts are told apart by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.hashing import BYTE, U64, mix, powers, inverse_powers, span_hashes
from cytoframe.llm.shared import in_slots, packed, partitions, ragged, release, repeated_slots, slices, written

LENGTH = 200
ANCHORS = (64, 128, LENGTH)
PIECE = 180  # windows of a context at most
MANY = 256
BUCKET_BYTES = 1 << 18
SLICE = 1 << 20
FIRST = 7  # symbols of nine bits that one number holds
_SECOND = mix(BYTE + U64(29))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every `width` consecutive values."""
    n = len(values)
    if n < width:
        return np.zeros(0, U64)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * powers(n), out=total[1:])
    return mix((total[width:] - total[:-width]) * inverse_powers(n + 1)[: n - width + 1])


def contexts(data: np.ndarray, offsets: np.ndarray, anchor: int = ANCHORS[0]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window, number of windows and text of every context, and the hash of every `anchor` bytes."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return np.zeros(0, U64), none, none, none, np.zeros(0, U64)
    h = rolling(BYTE[data], anchor)
    span = LENGTH - anchor + 1
    low, size = h, 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    low = np.minimum(low[: n - LENGTH + 1], low[span - size : span - size + n - LENGTH + 1])
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    starts = np.zeros(n - LENGTH + 2, np.int8)
    np.add.at(starts, offsets[:-1][long], 1)
    np.add.at(starts, offsets[1:][long] - LENGTH + 1, -1)
    left = np.cumsum(starts[:-1]) > 0  # windows inside one text
    head = left.copy()
    head[1:] &= (low[1:] != low[:-1]) | ~left[:-1]
    head[offsets[:-1][long]] = True
    first = np.flatnonzero(head)
    stop = np.append(first[1:], n - LENGTH + 1)
    text = np.searchsorted(offsets, first, side="right") - 1
    windows = np.minimum(stop, offsets[1:][text] - LENGTH + 1) - first
    pieces = -(-windows // PIECE)
    if (pieces > 1).any():
        k = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        total = np.repeat(windows, pieces)
        first, text = np.repeat(first, pieces) + k * PIECE, np.repeat(text, pieces)
        windows = np.minimum(total - k * PIECE, PIECE)
    return low[first], first, windows, text, h


def holds_anchor_twice(h: np.ndarray, value: np.ndarray, first: np.ndarray, windows: np.ndarray, anchor: int = ANCHORS[0]) -> np.ndarray:
    """Whether each context holds its anchor more than once, as it must if one of its windows repeats in it."""
    if not len(first):
        return np.zeros(0, bool)
    size = windows + LENGTH - anchor
    same = h[ragged(first, size)] == np.repeat(value, size)
    return np.add.reduceat(same, np.cumsum(size) - size, dtype=np.int64) > 1


def _ordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pairs (a, b), all below their number + 1, and whether each differs from the one before."""
    n = len(a)
    if n < (1 << 21) - 1:  # pair and place fit in one number, whose sort is far faster than an order
        key = np.sort((a << 21 | b) << 21 | np.arange(n))
        order, key = key & ((1 << 21) - 1), key >> 21
    else:
        key = a << 32 | b
        order = np.argsort(key)
        key = key[order]
    return order, key[1:] != key[:-1]


class RunIndex:
    """Run-length Burrows-Wheeler transform of some strings, with sampled run ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        size = np.diff(offsets)
        self.starts = offsets[:-1] + np.arange(len(size))
        n = int(offsets[-1]) + len(size)
        text = np.zeros(n + FIRST, np.int64)
        text[ragged(self.starts, size)] = data.astype(np.int64) + 1  # 0 ends a string
        ends = self.starts + size
        key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(FIRST):
            key = key << 9 | np.where(open_, text[i : n + i], 0)
            open_ &= text[i : n + i] > 0
        # suffixes that reach their string's end are unlike all others: each string's end is a symbol of its own
        near_end = np.flatnonzero(~open_)
        order = np.argsort(key)
        value = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
        alone = np.zeros(n, np.int64)
        alone[near_end] = 1 + np.arange(len(near_end))
        order, new_run = _ordered(rank, alone)
        rank[order] = np.cumsum(np.concatenate([[0], new_run]))
        text = text[:n]
        text[ends] = 256 + 1 + np.arange(len(size))
        levels, width = [(FIRST, rank)], FIRST
        while True:
            ahead = np.full(n, -1, np.int64)
            if width < n:
                ahead[:-width] = rank[width:]
            order, new_run = _ordered(rank, ahead + 1)
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.concatenate([[0], new_run]))
            rank, width = new, 2 * width
            levels.append((width, rank))
            if width >= 2 * LENGTH or int(rank.max(initial=0)) == n - 1:
                break
        self.levels, self.n, self.text = levels, n, text
        suffix = order
        before = text[suffix - 1]
        self.run_heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.run_symbols = before[self.run_heads]
        k = self.run_heads[1:]
        common = self.common_prefix(suffix[k - 1], suffix[k])
        self.sample_places = np.concatenate([suffix[k], suffix[k - 1]])  # first suffix of a run, last of the run before
        self.sample_lengths = np.concatenate([common, common])

    def common_prefix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        length = np.zeros(len(i), np.int64)
        for width, rank in reversed(self.levels):
            ok = (i + length < self.n) & (j + length < self.n)
            same = np.zeros(len(i), bool)
            same[ok] = rank[(i + length)[ok]] == rank[(j + length)[ok]]
            length += same * width
        live = np.arange(len(i))
        for _ in range(FIRST - 1):
            live = live[(i[live] + length[live] < self.n) & (j[live] + length[live] < self.n)]
            live = live[self.text[i[live] + length[live]] == self.text[j[live] + length[live]]]
            length[live] += 1
        return length

    def matching_statistics(self) -> np.ndarray:
        """For every place of the text, the longest match that starts anywhere else."""
        m = np.zeros(self.n, np.int64)
        np.maximum.at(m, self.sample_places, self.sample_lengths)
        return np.maximum.accumulate(m + np.arange(self.n)) - np.arange(self.n)

    def repeated(self, length: int) -> list[np.ndarray]:
        """For each string, the starts of the substrings of that length that start elsewhere too."""
        m = self.matching_statistics() >= length
        return [np.flatnonzero(m[a:b]) for a, b in zip(self.starts, np.append(self.starts[1:], self.n), strict=True)]


def _anchors(anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                a, first, windows, _, h = contexts(*packed(part.column(0)), anchor)
                value, at = np.unique(a, return_inverse=True)
                times = np.bincount(at, 1 + holds_anchor_twice(h, a, first, windows, anchor), len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)], names=["_a", "_n"])

    return run


def _rows(cells, anchor: int):
    """Contexts with the digest of their bytes; at the longest anchor that of their one window, however often it follows itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                data, offsets = packed(part.column(2))
                a, first, windows, text, h = contexts(data, offsets, anchor)
                p = np.flatnonzero(in_slots(cells.value, a))
                a, first, windows, text = a[p], first[p], windows[p], text[p]
                end = first + (0 if anchor == LENGTH else windows - 1) + LENGTH
                t = pa.array(text)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(span_hashes(BYTE[data], first, end).view(np.int64)), pa.array(span_hashes(_SECOND[data], first, end).view(np.int64)), part.column(0).take(t), part.column(1).take(t), pa.array(first - offsets[text]), pa.array(windows), pa.array(holds_anchor_twice(h, a, first, windows, anchor))], names=["_a", "_c", "_d", "_doc", "_t", "_from", "_w", "_own"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted contexts of each text."""
    for batch in batches:
        for part in slices(batch, "_text", SLICE):
            data, offsets = packed(part.column(0))
            raw = data.tobytes()
            want = part.column(1)
            owner = np.repeat(np.arange(part.num_rows), np.asarray(want.value_lengths().fill_null(0)))
            flat = want.flatten()
            a = offsets[owner] + flat.field("_from").to_numpy()
            b = a + flat.field("_w").to_numpy() - 1 + LENGTH
            yield pa.RecordBatch.from_arrays([flat.field("_a"), flat.field("_c"), flat.field("_d"), flat.field("_many"), pa.array([raw[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())], names=["_a", "_c", "_d", "_many", "_bytes"])


def _indexed(group: pa.Table) -> pa.Table:
    """Marked windows of the contexts of one bucket, by the run-length index."""
    data, offsets = packed(group.column("_bytes"))
    found = RunIndex(data, offsets).repeated(LENGTH)
    some = np.array([i for i, f in enumerate(found) if len(f)], np.int64)
    lists = pa.array([found[i].tolist() for i in some], pa.list_(pa.int32()))
    return pa.table([group.column("_c").take(pa.array(some)), group.column("_d").take(pa.array(some)), lists], names=["_c", "_d", "_marks"])


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marked windows of a context as stretches of bytes of its document."""
    for batch in batches:
        marks = batch.column(3)
        owner = np.repeat(np.arange(batch.num_rows), np.asarray(marks.value_lengths().fill_null(0)))
        at = batch.column(2).to_numpy()[owner] + np.asarray(marks.flatten())
        new = np.ones(len(at), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1)
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(at)) - 1
        p = pa.array(owner[head])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(p), batch.column(1).take(p), pa.array(at[head]), pa.array(at[last] + LENGTH)], names=["_doc", "_t", "_from", "_to"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stretches of each text as maximal ones: those that touch or overlap become one."""
    for batch in batches:
        spans = batch.column(2)
        number = np.asarray(spans.value_lengths().fill_null(0)).astype(np.int64)
        flat = spans.flatten()
        a, b = flat.field("_from").to_numpy(), flat.field("_to").to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), number)
        # ends never fall along a text: shift each text beyond the one before
        shift = owner * (int(b.max()) + 2 if len(b) else 0)
        top = np.maximum.accumulate(b + shift) if len(b) else b
        new = np.ones(len(a), bool)
        new[1:] = a[1:] + shift[1:] > top[:-1]
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(a)) - 1
        to = np.concatenate([[0], np.cumsum(np.bincount(owner[head], minlength=batch.num_rows))])
        lists = pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.StructArray.from_arrays([pa.array(a[head]), pa.array((top - shift)[last])], names=["_from", "_to"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["_doc", "_t", "_spans"])


def _spans(stretches: DataFrame) -> DataFrame:
    """One row a text: its maximal stretches in order."""
    per = stretches.groupBy("_doc", "_t").agg(F.array_sort(F.collect_set(F.struct("_from", "_to"))).alias("_spans"))
    return per.mapInArrow(_joined, "_doc long, _t long, _spans array<struct<_from:long,_to:long>>")


def _covered(texts: DataFrame, level: int) -> DataFrame:
    """Rows (_doc, _t, _spans): for each of the texts (_doc, _t, _text) the maximal stretches that windows cover which start elsewhere in them too."""
    anchor = ANCHORS[level]
    often = texts.select("_text").mapInArrow(_anchors(anchor), "_a long, _n long").groupBy("_a").agg(F.sum("_n").alias("_n")).where("_n > 1")
    cells = repeated_slots(often, "_a")
    rows = written(texts.mapInArrow(_rows(cells, anchor), "_a long, _c long, _d long, _doc long, _t long, _from long, _w long, _own boolean"), "contexts")
    cells.unpersist()
    kinds = written(rows.groupBy("_a", "_c", "_d").agg((F.sum("_w") if anchor == LENGTH else F.count("*")).alias("_n"), F.min(F.struct("_doc", "_t", "_from", "_w")).alias("_one"), F.max("_own").alias("_own")), "kinds")
    twice = rows.join(kinds.where("_n > 1").select("_a", "_c", "_d"), ["_a", "_c", "_d"], "left_semi").select("_doc", "_t", "_from", (F.col("_from") + F.col("_w") - 1 + LENGTH).alias("_to"))
    if anchor == LENGTH:
        return written(_spans(twice), "covered")
    spread = kinds.groupBy("_a").agg(F.count("*").alias("_kinds"), F.sum(F.col("_one._w") + LENGTH).alias("_bytes"), F.max("_own").alias("_some_own")).where("_kinds > 1 or _some_own").drop("_some_own")
    spread = written(spread, "anchors")
    volume = spread.where(F.col("_kinds") <= MANY).agg(F.sum("_bytes")).first()[0] or 0
    some_hot = not spread.where(F.col("_kinds") > MANY).isEmpty()
    buckets = max(partitions(texts), 1 + volume // BUCKET_BYTES)
    wanted = kinds.join(spread, "_a").select("_one._doc", "_one._t", F.struct("_a", "_c", "_d", (F.col("_kinds") > MANY).alias("_many"), "_one._from", "_one._w").alias("_want"))
    wanted = wanted.groupBy("_doc", "_t").agg(F.collect_list("_want").alias("_want"))
    pieces = written(texts.join(wanted, ["_doc", "_t"]).select("_text", "_want").mapInArrow(_cut, "_a long, _c long, _d long, _many boolean, _bytes binary"), "pieces")
    few = pieces.where("not _many").select(F.pmod(F.xxhash64("_a"), F.lit(buckets)).cast("int").alias("_bucket"), "_c", "_d", "_bytes").dropDuplicates(["_bucket", "_c", "_d"])
    marks = written(few.groupBy("_bucket").applyInArrow(_indexed, "_c long, _d long, _marks array<int>"), "marks")
    single = kinds.where("_n = 1").select("_c", "_d", "_one")
    once = single.join(marks, ["_c", "_d"]).select("_one._doc", "_one._t", "_one._from", "_marks").mapInArrow(_intervals, "_doc long, _t long, _from long, _to long")
    found = once.union(twice)
    if some_hot:
        inner = _covered(pieces.where("_many").select(F.col("_c").alias("_doc"), F.col("_d").alias("_t"), F.col("_bytes").alias("_text")).dropDuplicates(["_doc", "_t"]), level + 1)
        inner = single.join(inner.select(F.col("_doc").alias("_c"), F.col("_t").alias("_d"), "_spans"), ["_c", "_d"]).select("_one._doc", "_one._t", F.col("_one._from").alias("_at"), F.explode("_spans").alias("_x"))
        found = found.union(inner.select("_doc", "_t", F.col("_at") + F.col("_x._from"), F.col("_at") + F.col("_x._to")))
    found = written(_spans(found), "covered")
    release(rows, kinds, spread, pieces, marks)
    return found


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """Rows (_doc, _t, _spans): for each document and hash of its text the stretches of bytes that repeated windows cover.

    Only the columns doc_id and text are read, so others may have any name.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_t"), F.col("text").alias("_text")).where("_doc is not null and _text is not null")
    return _covered(texts, 0)


def drop_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, spans.

    Bytes covered by a 200-byte string that starts anywhere else too are removed, the first occurrence included. Null texts count as
    empty; rows whose id is null neither lose nor match. A repeated row is an occurrence of its own, so its text repeats whole.
    """
    each = repeated_stretches(docs)
    fields = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>").fields])
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                data, offsets = packed(part.column(1))
                raw = data.tobytes()
                rows = []
                for i in range(part.num_rows):
                    own = raw[offsets[i] : offsets[i + 1]]
                    merged: list[list[int]] = []
                    for s in part.column(2)[i].as_py() or ():
                        if merged and s["_from"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], s["_to"])
                        else:
                            merged.append([s["_from"], s["_to"]])
                    keep, at = hashlib.sha256(), 0
                    for a, b in merged:
                        keep.update(own[at:a])
                        at = b
                    keep.update(own[at:])
                    rows.append((len(own), sum(b - a for a, b in merged), len(merged), keep.hexdigest(), [{"start": a, "end": b} for a, b in merged]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=names)

    rows = docs.select("doc_id", F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_t"), F.col("text").alias("_text"))
    return rows.join(each, ["_doc", "_t"], "left").select("doc_id", "_text", "_spans").mapInArrow(run, fields)
