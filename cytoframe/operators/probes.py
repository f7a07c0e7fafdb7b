"""Barcodes and UMIs of reads, by local alignment of a probe to the start of each read.

The alignment runs in Arrow batches: the dynamic programme advances over all reads of a slice at once. What the alignment means
(adapter distance, barcode, UMI, their qualities, trimming) is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.functions import seq
from cytoframe.operators.kits import Kit

WINDOW = 100
SLICE = 2048  # reads aligned together
STOP, DIAGONAL, READ_GAP, PROBE_GAP = range(4)


@dataclass(frozen=True)
class Scores:
    """Opening a gap costs gap_open, each further base gap_extend or, where that is less, gap_open again; to_n: any base against N; N against N is a match."""

    match: int = 5
    mismatch: int = -1
    to_n: int = 1
    gap_open: int = 2
    gap_extend: int = 4

    def table(self) -> np.ndarray:
        """Score of each byte pair; letters other than ACGTN match nothing."""
        out = np.full((256, 256), self.mismatch, np.int32)
        for b in b"ACGTN":
            for x in (b, b + 32):
                for y in (b, b + 32):
                    out[x, y] = self.match
        for b in b"ACGTacgt":
            for n in b"Nn":
                out[b, n] = out[n, b] = self.to_n
        return out


def local_alignments(reads: list[bytes], probe: bytes, scores: Scores = Scores()) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """Aligned probe and read ('-' for gaps) of the best local alignment of each read, the place of the last aligned base, and the score.

    Of equal alignments, the one that ends first in the read, then in the probe, counts; going back, a pair of bases is taken before a
    gap in the read, and that before a gap in the probe.
    """
    n, m = len(reads), len(probe)
    width = max([len(r) for r in reads], default=0)
    x = np.zeros((width, n), np.uint8)
    for i, r in enumerate(reads):
        x[: len(r), i] = np.frombuffer(r, np.uint8)
    size = np.array([len(r) for r in reads])
    table, low = scores.table(), np.int32(-(1 << 28))
    h, f = np.zeros((m + 1, n), np.int32), np.full((m + 1, n), low, np.int32)
    back = np.zeros((width + 1, m + 1, n), np.uint8)
    best, at, to = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    p = np.frombuffer(probe, np.uint8)
    for i in range(1, width + 1):
        inside = i <= size
        pairs = table[x[i - 1]][:, p].T  # probe, read
        e = np.full(n, low, np.int32)
        above = h.copy()
        # a gap in the probe: the read's base stands against nothing
        opened, longer = above - scores.gap_open, f - scores.gap_extend
        f = np.maximum(opened, longer)
        more_f = longer > opened
        for j in range(1, m + 1):
            opened, longer = h[j - 1] - scores.gap_open, e - scores.gap_extend
            e = np.maximum(opened, longer)
            more_e = longer > opened
            diagonal = above[j - 1] + pairs[j - 1]
            value = np.maximum(np.maximum(diagonal, 0), np.maximum(e, f[j]))
            step = np.where(value == 0, STOP, np.where(value == diagonal, DIAGONAL, np.where(value == e, READ_GAP, PROBE_GAP)))
            back[i, j] = step | more_e << 2 | more_f[j] << 3
            h[j] = value
            better = inside & (value > best)
            best[better], at[better], to[better] = value[better], i, j
    # all reads go back together
    row, col, lane = at.copy(), to.copy(), np.arange(n)
    live = best > 0
    state = np.zeros(n, np.int64)
    read_out, probe_out = [], []
    gap = ord("-")
    while live.any():
        b = back[row, col, lane]
        state = np.where(state == 0, b & 3, state)
        live &= ~((state == STOP) & live)
        if not live.any():
            break
        d, rg, pg = (live & (state == k) for k in (DIAGONAL, READ_GAP, PROBE_GAP))
        read_out.append(np.where(d | pg, x[np.maximum(row - 1, 0), lane], np.where(rg, gap, 0)).astype(np.uint8))
        probe_out.append(np.where(d | rg, p[np.maximum(col - 1, 0)], np.where(pg, gap, 0)).astype(np.uint8))
        stay = (rg & (b & 4 > 0)) | (pg & (b & 8 > 0))
        row = row - (d | pg)
        col = col - (d | rg)
        state = np.where(stay, state, 0)
    turn = lambda out: [bytes(v[v > 0]) for v in np.ascontiguousarray(np.array(out[::-1], np.uint8).reshape(-1, n).T)]
    return turn(probe_out), turn(read_out), at - 1, best


def align_probe(reads: DataFrame, probe: str, *, scores: Scores = Scores()) -> DataFrame:
    """reads with a column prefix, plus probe_aln, read_aln (aligned texts), end_query (place of the last aligned base, -1 if none) and score."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema.fields)
    at = reads.columns.index("prefix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                a, b, end, score = local_alignments([(v or "").encode() for v in part.column(at).to_pylist()], probe.encode(), scores)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([v.decode() for v in a], pa.string()), pa.array([v.decode() for v in b], pa.string()), pa.array(end, pa.int32()), pa.array(score, pa.int32())], names=[*part.schema.names, "probe_aln", "read_aln", "end_query", "score"])

    return reads.mapInArrow(run, f"{fields}, probe_aln string, read_aln string, end_query int, score int")


def extract_barcodes(reads: DataFrame, kit: Kit, *, window: int = WINDOW, max_adapter_edits: int = 3, scores: Scores = Scores()) -> DataFrame:
    """Rows (read_id, CR, CY, UR, UY, adapter1_ed, seq, qual) of the reads (read_id, seq, qual) that hold the kit's probe.

    The probe is sought in the first `window` bases, of the reverse complement where the kit's reads run against the barcode. Reads whose
    adapter is more than max_adapter_edits away, or without barcode or UMI, are left out. Qualities are those of the first place where
    the barcode (UMI) stands in the prefix. seq and qual lose what was read; nothing is cut where that would be less than no base.
    """
    s, q = (seq.reverse_complement(F.col("seq")), F.reverse("qual")) if kit.reversed else (F.col("seq"), F.col("qual"))
    prefixed = reads.select("read_id", "seq", "qual", F.substring(s, 1, window).alias("prefix"), F.substring(q, 1, window).alias("prefix_qual"))
    found = align_probe(prefixed, kit.probe, scores=scores)
    first = F.instr("probe_aln", "N")
    part = lambda a, n: F.regexp_replace(F.substring(F.col("read_aln"), a, n), "-", "")
    has = first > 0
    named = found.select("*", F.when(has, F.levenshtein(F.substring(F.col("read_aln"), F.lit(1), first - 1), F.lit(kit.suffix))).otherwise(len(kit.suffix)).alias("adapter1_ed"), F.when(has, part(first, F.lit(kit.barcode_length))).otherwise("").alias("CR"), F.when(has, part(first + kit.barcode_length, F.lit(kit.umi_length))).otherwise("").alias("UR"))
    quality = lambda c: F.substring(F.col("prefix_qual"), F.instr(F.col("prefix"), F.col(c)), F.length(c))
    cut = F.greatest(F.col("end_query") - 1 - kit.polyt_length, F.lit(0)) if kit.reversed else F.greatest(F.col("end_query"), F.lit(0))
    rest = lambda c: F.substring(F.col(c), F.lit(1) if kit.reversed else cut + 1, F.greatest(F.length(c) - cut, F.lit(0)))
    kept = named.where((F.col("adapter1_ed") <= max_adapter_edits) & (F.col("CR") != "") & (F.col("UR") != ""))
    return kept.select("read_id", "CR", quality("CR").alias("CY"), "UR", quality("UR").alias("UY"), "adapter1_ed", rest("seq").alias("seq"), rest("qual").alias("qual"))


def high_quality_counts(tags: DataFrame, long_list: DataFrame | None = None, *, min_quality: int = 15) -> DataFrame:
    """Rows (barcode, count) of uncorrected barcodes (CR, CY) none of whose bases is below min_quality; with a list, only barcodes in it."""
    good = tags.where(seq.phred_min(F.col("CY")) >= min_quality)
    if long_list is not None:
        good = good.join(long_list.select(F.col("barcode").alias("CR")), "CR", "left_semi")
    return good.groupBy(F.col("CR").alias("barcode")).count()
