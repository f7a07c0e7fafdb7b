"""Benchmark decontamination by spaced seeds over words.

A mask fixes which of some consecutive words count and which are ignored. Documents and benchmark items are hashed under each mask
at every word; equal hashes are hits, and around each hit the words of document and item are compared along the hit's diagonal. A
pair overlaps if some SPAN consecutive words (the whole item, if shorter) agree in at least SHARE of their places, so single
substitutions do not hide a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.hashing import U64, mix, word_hashes
from cytoframe.llm.shared import in_slots, packed, ragged, repeated_slots, slices

#: With these, each window of SPAN words at SHARE has a hit; items of fewer words need those of their length too.
MASKS = ("111111", "110110111", "1101010111", "101101001011", "1101111")
SHORT = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("1111", "10111", "11011", "11101"),
    6: ("11111", "101111", "110111", "111011", "111101"),
    7: ("11111", "110111", "111011"),
    8: ("1111011",),
    10: ("11100111", "11011011", "1100101011"),
    11: ("11100111", "1111011"),
    12: ("11001111",),
}
SPAN, SHARE = 13, 0.8
SIDE = 64  # words kept on either side of a hit for its verification; more than SPAN


def masks_for(lengths) -> tuple[str, ...]:
    """The masks that items of these lengths need."""
    return tuple(dict.fromkeys([*MASKS, *(m for n in sorted(lengths) for m in SHORT.get(n, ()))]))


def seed_hashes(hashes: np.ndarray, counts: np.ndarray, masks: tuple[str, ...] = MASKS, *, items: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every masked stretch that lies within its text, and its first word's index; `items`: only under masks for the text's length."""
    owner_end = np.repeat(np.cumsum(counts), counts)
    size = np.repeat(counts, counts)
    out, place = [], []
    for mask in masks:
        fits = np.arange(len(hashes)) + len(mask) <= owner_end
        if items and mask not in MASKS:
            fits &= np.isin(size, [n for n, own in SHORT.items() if mask in own])
        at = np.flatnonzero(fits)
        h = np.full(len(at), int(mask, 2), U64)
        for i, keep in enumerate(mask):
            if keep == "1":
                h = h * U64(0x9E3779B97F4A7C15) + hashes[at + i]
        out.append(mix(h))
        place.append(at)
    return np.concatenate(out), np.concatenate(place)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's words as hashes."""
    for batch in batches:
        h, _, _, counts = word_hashes(*packed(batch.column(1)), letters=True)
        to = np.concatenate([[0], np.cumsum(counts)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h[a:b].tobytes() for a, b in zip(to[:-1], to[1:], strict=True)], pa.binary())], names=["_item", "_words"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Seeds of the items, each with its place."""
    for batch in batches:
        for part in slices(batch, "_text", 1 << 18):
            h, _, _, counts = word_hashes(*packed(part.column(1)), letters=True)
            begin = np.cumsum(counts) - counts
            seeds, at = seed_hashes(h, counts, masks_for(range(SPAN)), items=True)
            owner = np.repeat(np.arange(part.num_rows), counts)[at]
            yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), part.column(0).take(pa.array(owner)), pa.array(at - begin[owner], pa.int32())], names=["_seed", "_item", "_at"])


def best_overlap(doc: np.ndarray, doc_at: int, item: np.ndarray, item_at: int, span: int = SPAN) -> tuple[int, int, int]:
    """Along one diagonal: most agreeing places in `span` consecutive words, where that window starts in doc, and its length."""
    back = min(doc_at, item_at)
    n = min(len(doc) - doc_at, len(item) - item_at) + back
    same = doc[doc_at - back : doc_at - back + n] == item[item_at - back : item_at - back + n]
    size = min(span, len(item))
    if n < size:
        return 0, doc_at, size
    total = np.concatenate([[0], np.cumsum(same)])
    sums = total[size:] - total[:-size]
    k = int(sums.argmax())
    return int(sums[k]), doc_at - back + k, size


def overlaps(docs: DataFrame, benchmark: DataFrame, *, span: int = SPAN, share: float = SHARE, short: bool = False) -> DataFrame:
    """Pairs of document and benchmark item that overlap: doc_id, item_id, n_same (agreeing words of the best window), n_words (its length).

    Words are runs of letters and digits, ASCII case folded. Null texts and texts or items of fewer words than the shortest mask
    overlap with nothing, or with `short`, which adds the masks of short items, those without words; so do rows whose id is null. Repeated rows give one pair; empty tables give none.
    The documents are scanned once: seeds are tested against a bitmap (its size is fixed, whatever the benchmark's
    size) and only seeds that pass leave the scan, with the words around them, for an equi-join with the benchmark's seeds.
    """
    known = benchmark.select(F.col("item_id").cast("long").alias("_item"), F.col("text").alias("_text")).where("_item is not null")
    items = known.mapInArrow(_item_seeds, "_seed long, _item long, _at int").distinct()
    words = known.mapInArrow(_item_words, "_item long, _words binary").distinct()
    lengths = words.select(F.expr("int(length(_words) div 8)").alias("_n")).where(f"_n < {SPAN}").distinct().collect() if short else []
    masks = masks_for([r["_n"] for r in lengths])
    shared = repeated_slots(items, "_seed")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                h, _, _, counts = word_hashes(*packed(part.column(1)), letters=True)
                begin = np.cumsum(counts) - counts
                seeds, at = seed_hashes(h, counts, masks)
                hit = np.flatnonzero(in_slots(shared.value, seeds))
                if not len(hit):
                    continue
                owner = np.repeat(np.arange(part.num_rows), counts)[at[hit]]
                low = np.maximum(at[hit] - SIDE, begin[owner])
                high = np.minimum(at[hit] + SIDE, begin[owner] + counts[owner])
                around = h[ragged(low, high - low)]
                to = np.concatenate([[0], np.cumsum(high - low)]) * 8
                raw = around.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(seeds[hit].view(np.int64)), part.column(0).take(pa.array(owner)), pa.array(at[hit] - low, pa.int32()), pa.array(at[hit] - begin[owner]), pa.array([raw[a:b] for a, b in zip(to[:-1], to[1:], strict=True)], pa.binary())], names=["_seed", "_doc", "_here", "_place", "_around"])

    hits = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).where("_doc is not null and _text is not null").mapInArrow(scan, "_seed long, _doc long, _here int, _place long, _around binary")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            done: set[tuple] = set()
            for doc, item, here, at, place, around, words in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                key = (doc, item, place - at, place // SIDE)
                if key in done:
                    continue
                same, _, size = best_overlap(np.frombuffer(around, U64), here, np.frombuffer(words, U64), at, span)
                if same >= share * size:
                    rows.append((doc, item, same, size))
                    done.add(key)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "item_id", "n_same", "n_words"])

    pairs = hits.join(items, "_seed").join(words, "_item").select("_doc", "_item", "_here", "_at", "_place", "_around", "_words").mapInArrow(verify, "doc_id long, item_id long, n_same long, n_words long")
    return pairs.groupBy("doc_id", "item_id").agg(F.max("n_same").alias("n_same"), F.max("n_words").alias("n_words"))
