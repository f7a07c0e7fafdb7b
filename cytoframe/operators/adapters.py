"""Adapters in reads: search, and hits to stranded subreads."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Labels of reads without a compatible pair.
LABELS = {
    "*": "no_adapters",
    "adapter1_f": "single_adapter1",
    "adapter1_r": "single_adapter1",
    "adapter2_f": "single_adapter2",
    "adapter2_r": "single_adapter2",
    "adapter1_f-adapter1_r": "double_adapter1",
    "adapter1_r-adapter1_f": "double_adapter1",
    "adapter2_f-adapter2_r": "double_adapter2",
    "adapter2_r-adapter2_f": "double_adapter2",
}
PAIRS = {"adapter1_f-adapter2_f": "+", "adapter2_r-adapter1_r": "-"}


def configurations(hits: DataFrame) -> DataFrame:
    """Rows (query, config): the targets of each read's hits in order of their place, joined by '-'."""
    return hits.groupBy("query").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("qilo", "target"))), lambda h: h["target"]), "-").alias("config"))


def summary(subreads: DataFrame) -> DataFrame:
    """Rows (statistic, count): subreads, full-length, stranded, plus and minus ones, and one row for each label of LABELS and PAIRS."""
    flag = {"subreads": F.lit(True), "full_length": F.col("fl"), "stranded": F.col("strand") != "*", "plus": F.col("strand") == "+", "minus": F.col("strand") == "-"}
    flag |= {lab: F.col("lab") == lab for lab in dict.fromkeys([*LABELS.values(), "full_len", "other"])}
    one = subreads.agg(*[F.count_if(c).alias(k) for k, c in flag.items()])
    return one.unpivot([], list(flag), "statistic", "count")


def subreads(hits: DataFrame) -> DataFrame:
    """Hits (query, target, qilo, qihi, ql) to one row per compatible neighbouring pair, or one per read without any."""
    w = Window.partitionBy("query").orderBy("qilo", "target")
    nxt = hits.withColumn("_t2", F.lead("target").over(w)).withColumn("_lo2", F.lead("qilo").over(w)).withColumn("_hi2", F.lead("qihi").over(w))
    config = F.concat_ws("-", "target", "_t2")
    pairs = nxt.where(F.col("_t2").isNotNull() & config.isin(*PAIRS)).withColumn("adapter_config", config)
    plus = F.col("adapter_config") == "adapter1_f-adapter2_f"
    number = F.row_number().over(Window.partitionBy("query").orderBy(F.when(plus, 0).otherwise(1), "qilo")) - 1
    full = pairs.select("query", F.concat_ws("_", "query", number).alias("read_id"), F.when(plus, F.col("qilo") - 1).otherwise(F.col("qihi")).alias("start"), F.when(plus, F.col("_lo2") - 1).otherwise(F.col("_hi2")).alias("end"), F.lit(True).alias("fl"), F.when(plus, "+").otherwise("-").alias("strand"), "adapter_config", F.lit("full_len").alias("lab"))
    reads = hits.groupBy("query").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("qilo", "target"))), lambda h: h["target"]), "-").alias("adapter_config"), F.max("ql").alias("_ql"), F.min("qilo").alias("_lo"), F.max("qihi").alias("_hi"))
    none = reads.join(full.select("query").distinct(), "query", "left_anti")
    c = F.col("adapter_config")
    label = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), c), F.lit("other"))
    strand = F.when(c.isin("adapter1_f", "adapter2_f"), "+").when(c.isin("adapter1_r", "adapter2_r"), "-").otherwise("*")
    start = F.when(c.isin("adapter1_f", "adapter2_r"), F.col("_lo") - 1).otherwise(0)
    end = F.when(c.isin("adapter2_f", "adapter1_r"), F.col("_hi")).otherwise(F.col("_ql"))
    return full.unionByName(none.select("query", F.concat_ws("_", "query", F.lit(0)).alias("read_id"), start.alias("start"), end.alias("end"), F.lit(False).alias("fl"), strand.alias("strand"), "adapter_config", label.alias("lab")))


SHORTEST = 20  # reads of fewer bases are left out of the search


def _masks(adapter: bytes) -> np.ndarray:
    """For each byte, the places of the adapter where it stands, as bits."""
    out = np.zeros(256, np.uint64)
    for i, b in enumerate(adapter):
        for x in {b, b ^ 32}:
            out[x] |= np.uint64(1 << i)
    return out


def best_ends(reads: list[bytes], adapters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(reads, adapters): smallest edit distance of each adapter to any stretch of each read, and where the first such stretch ends.

    A bit-vector holds one column of the edit matrix; the columns of all reads and adapters advance together. Adapters have at most 63 bases.
    """
    n, k = len(reads), len(adapters)
    width = max([len(r) for r in reads], default=0)
    text = np.zeros((width, n), np.uint8)
    for i, r in enumerate(reads):
        text[: len(r), i] = np.frombuffer(r, np.uint8)
    size = np.array([len(r) for r in reads])
    masks = np.stack([_masks(a) for a in adapters], 1)
    length = np.array([len(a) for a in adapters])
    top = np.uint64(1) << (length - 1).astype(np.uint64)
    up, down = np.full((n, k), ~np.uint64(0)), np.zeros((n, k), np.uint64)
    score = np.tile(length, (n, 1))
    best, end = score.copy(), np.zeros((n, k), np.int64)
    one = np.uint64(1)
    for i in range(width):
        eq = masks[text[i]]
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up)
        mh = up & xh
        score = score + ((ph & top) > 0) - ((mh & top) > 0)
        ph, mh = ph << one, mh << one
        up, down = mh | ~(xv | ph), ph & xv
        better = (score < best) & (i < size)[:, None]
        best[better], end[better] = score[better], i + 1
    return best, end


def _begins(reads: list[bytes], adapters: list[bytes], lane: np.ndarray, which: np.ndarray, ends: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Where the stretch that ends at `ends` begins: the shortest one of that distance. One matrix over a short window of each hit."""
    longest = max(len(a) for a in adapters)
    window = int(longest + distance.max())
    out = np.zeros(len(lane), np.int64)
    pad = np.zeros((len(lane), window), np.uint8)
    pattern = np.zeros((len(lane), longest), np.uint8)
    m = np.array([len(adapters[w]) for w in which])
    for i, (r, w, e) in enumerate(zip(lane.tolist(), which.tolist(), ends.tolist(), strict=True)):
        back = reads[r][max(0, e - window) : e][::-1]
        pad[i, : len(back)] = np.frombuffer(back, np.uint8)
        a = adapters[w][::-1]
        pattern[i, : len(a)] = np.frombuffer(a, np.uint8)
    same = lambda x, y: (x & 0xDF) == (y & 0xDF)
    row = np.broadcast_to(np.arange(longest + 1), (len(lane), longest + 1)).copy()
    found = np.zeros(len(lane), bool)
    rows = np.arange(len(lane))
    for j in range(window + 1):
        hit = ~found & (row[rows, m] == distance)
        out[hit], found = ends[hit] - j, found | hit
        if j == window:
            break
        new = np.empty_like(row)
        new[:, 0] = j + 1
        change = np.minimum(row[:, :-1] + ~same(pattern, pad[:, j : j + 1]), row[:, 1:] + 1)
        new[:, 1:] = change
        step = np.arange(longest + 1)
        row = np.minimum.accumulate(new - step, axis=1) + step
    return out


def search(reads: DataFrame, adapters: dict[str, str], *, min_identity: float = 0.7) -> DataFrame:
    """Hits (query, target, identity, qilo, qihi, ql) of the adapters in the reads (read_id, seq); a read without any has the target '*'.

    Each adapter gives at most one hit a read: the first stretch of the smallest edit distance d. Its identity is 1 - d over the longer of
    adapter and stretch; qilo and qihi are its first and last base, from one. Reads of fewer than SHORTEST bases have no row.
    """
    names, sequences = list(adapters), [a.encode() for a in adapters.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column(0).to_pylist(), [v.encode() for v in batch.column(1).to_pylist()]
            order = sorted(range(len(text)), key=lambda i: len(text[i]))  # reads of like length advance together
            for at in range(0, len(order), 512):
                pick = order[at : at + 512]
                own = [text[i] for i in pick]
                best, end = best_ends(own, sequences)
                length = np.array([len(a) for a in sequences])
                lane, which = np.nonzero(best <= (1 - min_identity) * (length + best))
                lo = _begins(own, sequences, lane, which, end[lane, which], best[lane, which]) if len(lane) else np.zeros(0, np.int64)
                hi = end[lane, which]
                identity = 1 - best[lane, which] / np.maximum(length[which], hi - lo)
                ok = identity >= min_identity
                lane, which, lo, hi, identity = lane[ok], which[ok], lo[ok], hi[ok], identity[ok]
                none = np.setdiff1d(np.arange(len(own)), lane)
                who = np.concatenate([lane, none])
                gap = lambda v, t: pa.array([*v.tolist(), *[None] * len(none)], t)
                yield pa.RecordBatch.from_arrays([pa.array([ids[pick[i]] for i in who], batch.column(0).type), pa.array([names[w] for w in which] + ["*"] * len(none), pa.string()), gap(identity, pa.float64()), gap(lo + 1, pa.int64()), gap(hi, pa.int64()), pa.array([len(own[i]) for i in who], pa.int64())], names=["query", "target", "identity", "qilo", "qihi", "ql"])

    kind = reads.schema["read_id"].dataType.simpleString()
    return reads.where(F.length("seq") >= SHORTEST).select("read_id", "seq").mapInArrow(run, f"query {kind}, target string, identity double, qilo long, qihi long, ql long")
