"""Token ids of a corpus in binary shards, each compressed by a Re-Pair grammar.

File format: a Parquet folder, one row per block of about a million ids (whole documents only). Blocks follow each other in
(shard, block) order, which is ascending doc_id order. Columns:

    shard, block        place of the block
    n_tokens            ids in the block
    doc_ids, doc_sizes  documents in order and the number of their ids, end id included
    rules               little-endian uint16 pairs; rule k stands for symbol FIRST_RULE + k and its two symbols are older
    rule_sizes          little-endian uint32: ids that each rule expands to
    symbols             little-endian uint16 sequence of ids and rule symbols; no rule crosses a document's end
    marks               little-endian uint64: ids before every MARK-th symbol, for random access

Ids must be below FIRST_RULE, so that rules fit in 16 bits with them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cytoframe.llm.bpe import SLICE, Merges
from cytoframe.llm.shared import binary_column, own_shuffles, packed, partitions, ragged, release, slices, written

FIRST_RULE = 50_304
MARK = 64
BLOCK_IDS = 1 << 20
RULES_A_ROUND, LEAST = 4_000, 4
WORDS_A_TEXT = 1_000
SCHEMA = "shard int, block int, n_tokens long, doc_ids array<long>, doc_sizes array<long>, rules binary, rule_sizes binary, symbols binary, marks binary"


@lru_cache(4)
def library(path: str) -> tuple[Merges, object]:
    """The library's tokenizer, and the pre-token splitter that feeds it each distinct pre-token once."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    alone = Tokenizer(whole.model)
    alone.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    splitter = Merges(path)
    shown = splitter.shown

    def plain(words: list[bytes]) -> tuple[list[int], np.ndarray]:
        """Ids of pre-tokens by the library's model, a thousand in one text: as characters of the byte-level alphabet they hold no blank."""
        text = " ".join(w.decode("latin-1").translate(shown) for w in words)
        e = alone.encode(text, add_special_tokens=False)
        return e.ids, np.bincount(np.array(e.word_ids, np.int64), minlength=len(words))

    def words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        every = [raw[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
        counts, parts, held = np.zeros(len(every), np.int64), [], []

        def flush(to: int) -> None:
            if held:
                ids, counts[to - len(held) : to] = plain(held)
                parts.append(ids)
                held.clear()

        for i, w in enumerate(every):
            if w in splitter.special:
                flush(i)
                parts.append(whole.encode(w.decode(), add_special_tokens=False).ids)
                counts[i] = len(parts[-1])
                continue
            held.append(w)
            if len(held) == WORDS_A_TEXT:
                flush(i + 1)
        flush(len(every))
        return np.fromiter(chain.from_iterable(parts), np.int64, int(counts.sum())), counts

    return splitter, words


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: rounds that replace the most frequent pairs by new symbols until none occurs LEAST times or 16 bits
    hold no more rules.

    ids: below FIRST_RULE; ends: positions of the last id of each document. Returns rules (n, 2), rule sizes and symbols.
    """
    if len(ids) and int(ids.max()) >= FIRST_RULE:
        raise ValueError("ids must be below FIRST_RULE")
    s = ids.astype(np.uint32)
    last = np.zeros(len(s), bool)
    last[ends] = True
    rules, sizes = [np.zeros((0, 2), np.uint32)], [np.zeros(0, np.int64)]
    made = 0
    while True:
        room = min(RULES_A_ROUND, (1 << 16) - FIRST_RULE - made)
        if len(s) < 2 or not room:
            break
        key = s[:-1] << 16 | s[1:]
        free = ~last[:-1]
        ordered = np.sort(key[free])
        if not len(ordered):
            break
        cut = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
        times = np.diff(cut)
        often = np.flatnonzero(times >= LEAST)
        if not len(often):
            break
        often = often[np.argsort(-times[often], kind="stable")[:room]]
        chosen = np.sort(ordered[cut[often]])
        slot = np.zeros(1 << 20, np.uint32)
        spread = lambda k: (k * np.uint32(2654435761)) >> np.uint32(12)
        taken = spread(chosen)
        slot[taken[::-1]] = np.arange(1, len(chosen) + 1, dtype=np.uint32)[::-1]
        chosen = chosen[np.sort(slot[np.unique(taken)]) - 1]  # a pair whose slot is taken waits for the next round
        slot[:] = 0
        slot[spread(chosen)] = np.arange(1, len(chosen) + 1, dtype=np.uint32)
        which = slot[spread(key)]
        hit = free & (which > 0)
        hit[hit] = chosen[which[hit] - 1] == key[hit]
        at = np.flatnonzero(hit)
        head = np.concatenate([[True], at[1:] != at[:-1] + 1])
        run = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]  # overlapping pairs: every second one of a run
        s[at] = FIRST_RULE + made + which[at] - 1
        last[at] = last[at + 1]
        keep = np.ones(len(s), bool)
        keep[at + 1] = False
        s, last = s[keep], last[keep]
        pair = np.stack([chosen >> 16, chosen & 0xFFFF], 1)
        older = np.concatenate(sizes)
        each = np.where(pair >= FIRST_RULE, older[np.maximum(pair.astype(np.int64) - FIRST_RULE, 0)] if len(older) else 1, 1).sum(1)
        rules.append(pair)
        sizes.append(each)
        made += len(chosen)
    return np.concatenate(rules), np.concatenate(sizes), s


def expansions(rules: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids that every symbol stands for: pool, start and size by symbol."""
    size = np.concatenate([np.ones(FIRST_RULE, np.int64), sizes])
    start = np.cumsum(size) - size
    pool = np.zeros(int(size.sum()), np.int64)
    pool[:FIRST_RULE] = np.arange(FIRST_RULE)
    done = 0
    while done < len(rules):  # rules whose parts are known, together
        ready = np.flatnonzero((rules[done:] >= FIRST_RULE + done).any(1))
        to = done + (int(ready[0]) if len(ready) else len(rules) - done)
        for side in (0, 1):
            part = rules[done:to, side].astype(np.int64)
            begin = start[FIRST_RULE + done : FIRST_RULE + to] + (size[rules[done:to, 0].astype(np.int64)] if side else 0)
            pool[ragged(begin, size[part])] = pool[ragged(start[part], size[part])]
        done = to
    return pool, start, size


def parsed(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["rules"], "<u2").reshape(-1, 2), np.frombuffer(row["rule_sizes"], "<u4").astype(np.int64), np.frombuffer(row["symbols"], "<u2").astype(np.int64)


def block_ids(row: dict) -> np.ndarray:
    """All ids of one block."""
    rules, sizes, symbols = parsed(row)
    pool, start, size = expansions(rules, sizes)
    return pool[ragged(start[symbols], size[symbols])]


def document_ids(row: dict, k: int) -> np.ndarray:
    """Ids of the block's k-th document, expanding only the symbols between two marks around it."""
    rules, sizes, symbols = parsed(row)
    pool, start, size = expansions(rules, sizes)
    marks = np.frombuffer(row["marks"], "<u8").astype(np.int64)
    before = int(sum(row["doc_sizes"][:k]))
    n = int(row["doc_sizes"][k])
    first = int(np.searchsorted(marks, before, side="right")) - 1
    to = int(np.searchsorted(marks, before + n, side="left"))
    some = symbols[first * MARK : to * MARK if to < len(marks) else None]
    ids = pool[ragged(start[some], size[some])]
    return ids[before - marks[first] :][:n]


def block_row(shard: int, block: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> dict:
    rules, sizes, symbols = compress(ids, np.cumsum(counts) - 1)
    each = np.concatenate([np.ones(FIRST_RULE, np.int64), sizes])[symbols]
    marks = (np.cumsum(each) - each)[::MARK]
    return {"shard": shard, "block": block, "n_tokens": len(ids), "doc_ids": doc_ids, "doc_sizes": counts.tolist(), "rules": rules.astype("<u2").tobytes(), "rule_sizes": sizes.astype("<u4").tobytes(), "symbols": symbols.astype("<u2").tobytes(), "marks": marks.astype("<u8").tobytes()}


def write_token_file(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encodes every whole text with the tokenizer library and writes the ids, in ascending id order, as a token file.

    Null texts count as empty (only the end id); rows of equal id stand next to each other, in the order of a hash of their texts, null
    ids first; an empty table gives an empty file. Texts are encoded where they are read; only ids (two bytes each) move, in a range
    exchange on id and hash, so rows of one id may lie in several ranges. Spark's committer writes the blocks, so a lost executor's
    tasks rerun.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, words = library(tokenizer)
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                ids, counts = splitter.encode(*packed(part.column(2)), words)
                if len(ids) and int(ids.max()) >= FIRST_RULE:
                    raise ValueError("ids must be below FIRST_RULE")
                out = np.full(len(ids) + len(counts), end_id, "<u2")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                to = np.concatenate([[0], np.cumsum(counts + 1)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), binary_column(out.view(np.uint8), 2 * to)], names=["_id", "_tie", "_ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        kinds = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("rules", pa.binary()), ("rule_sizes", pa.binary()), ("symbols", pa.binary()), ("marks", pa.binary())])

        def flush() -> pa.RecordBatch:
            row = block_row(shard, block, [i for h in held for i in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held]))
            held.clear()
            return pa.RecordBatch.from_pylist([row], kinds)

        size = 0
        for batch in batches:
            for part in slices(batch, "_ids"):
                data, offsets = packed(part.column(1))
                held.append((part.column(0).to_pylist(), np.diff(offsets) >> 1, np.frombuffer(data.tobytes(), "<u2")))
                size += len(data) >> 1
                if size >= BLOCK_IDS:
                    yield flush()
                    block, size = block + 1, 0
        if held:
            yield flush()

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.xxhash64(text_column).alias("_tie"), F.col(text_column).alias("_text"))
    encoded = written(rows.mapInArrow(encode, "_id long, _tie long, _ids binary"), "ids", "zstd")
    ordered = encoded.repartitionByRange(partitions(docs), "_id", "_tie").sortWithinPartitions("_id", "_tie").select("_id", "_ids")
    with own_shuffles(docs.sparkSession):
        ordered.mapInArrow(pack, SCHEMA).write.parquet(path)
    release(encoded)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a token file, decoded from its grammar: doc_id, start, n_tokens, ids_crc32 (of little-endian uint32 ids)."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    fields = "shard int, block int, doc_id long, before long, n_tokens long, ids_crc32 long"
    names = ["shard", "block", "doc_id", "before", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw = block_ids(row).astype("<u4").tobytes()
                sizes = np.array(row["doc_sizes"], np.int64)
                to = np.concatenate([[0], np.cumsum(sizes)])
                n = len(sizes)
                crc = [zlib.crc32(raw[4 * to[k] : 4 * to[k + 1]]) for k in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(to[:-1]), pa.array(sizes), pa.array(crc, pa.int64())], names=names)

    docs = blocks.mapInArrow(run, fields)
    by_block = blocks.select("shard", "block", "n_tokens")
    by_shard = by_block.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    shard_start = by_shard.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_shard_start"))
    block_start = by_block.select("shard", "block", (F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_tokens")).alias("_block_start"))
    starts = block_start.join(shard_start, "shard")
    return docs.join(starts, ["shard", "block"]).select("doc_id", (F.col("_shard_start") + F.col("_block_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
