"""Line deduplication by deletion neighbourhoods over words.

A line is a sequence of words (runs of other bytes than white space, ASCII case folded). A line is removed where an equal line, or,
for lines of MIN_WORDS words or more, one that differs by one word put in, left out or replaced, stands earlier in
(doc_id, line number) order. Words are the units of the edit distance: one edit in at least five words is the similarity of 0.8.

Distinct lines are found first. Two lines within one edit agree in the first or the last half of their words, so only lines
whose half occurs in another line emit variants: the hash of the whole line and, for each place, the hash without that word. Equal
variants join: two lines without the same place, or one whole and one without a place. Each such group needs only its earliest
line, so groups of any size are combined before they are exchanged and never multiplied out.

With `short`, two lines of at most CHAR_WORDS words (in which a split or joined word, two word edits, is more than a fifth) are near
too if they have MIN_WORDS characters or more and differ by one character. With `whole`, the bound also grows with the line: two lines
of MIN_WORDS words or more are near if their word edits are at most a fifth of the longer one's words. Lines of two edits or more are
found by pieces: a line of n >= 10 words holds more disjoint pieces of four words (three, for 10, 11 and 15) than edits are
allowed, so one piece stands unchanged in the other line. Each line is held against the earliest line that shares each of its pieces
first; only lines not removed by that meet all other lines that share a piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.hashing import LOWER, U64, inverse_powers, mix, powers, span_hashes, word_hashes
from cytoframe.llm.hashing import words as word_spans
from cytoframe.llm.shared import free_name, in_slots, packed, ragged, release, repeated_slots, slices, trim, written

MIN_WORDS = 5
CHAR_WORDS = 10
SHARE = 5  # one edit in so many words
CELLS = 1 << 21  # numbers that the edit distances of one go may take
PAIR = "_doc long, _line int, _doc2 long, _line2 int"
KEYS = ["_k0", "_k1", "_k2", "_k3"]
_OTHER = U64(0xD6E8FEB86659FD93)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, first word and words of every line, the line's text and its number in it."""
    cut = np.flatnonzero(data == 10)
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, cut, side="right") - 1])
    at = np.concatenate([offsets[:-1], cut + 1])
    order = np.lexsort((at, text))
    text, at = text[order], at[order]
    h, word_start, _, _ = word_hashes(data, offsets)
    first = np.searchsorted(word_start, at)
    stop = np.append(at[1:], len(data))
    words = np.searchsorted(word_start, stop) - first
    begin = np.searchsorted(text, np.arange(len(offsets) - 1))
    return h, first, words, text, np.arange(len(text)) - begin[text]


def _keys(h: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(lines, 4): hashes of the first and last words, for half of the line's length and half of one word less."""
    out = []
    for less in (0, 1):
        half = np.maximum((n - less - 1) // 2, 0)
        for k, (a, b) in enumerate(((first, first + half), (first + n - half, first + n))):
            out.append(mix(span_hashes(h, a, b) ^ (half.astype(U64) << U64(8)) ^ U64(k + 1)))
    return np.stack(out, 1)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest (two halves), half keys, text and number of every line that has words."""
    for batch in batches:
        for part in slices(batch, "_text"):
            h, first, n, text, number = _lines(*packed(part.column(1)))
            pick = np.flatnonzero(n > 0)
            first, n, text, number = first[pick], n[pick], text[pick], number[pick]
            whole, other = span_hashes(h, first, first + n), span_hashes(mix(h ^ _OTHER), first, first + n)
            key = _keys(h, first, n)
            absent = np.zeros(key.shape, bool)
            absent[n < MIN_WORDS] = True
            absent[n == MIN_WORDS, 2:] = True  # half of four words is no key for five
            keys = [pa.array(key[:, i].view(np.int64), mask=absent[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), pa.array(number, pa.int32()), pa.array(whole.view(np.int64)), pa.array(other.view(np.int64)), *keys], names=["_doc", "_line", "_h", "_g", *KEYS])


def _word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """_lines without those of fewer than MIN_WORDS words."""
    h, first, n, text, number = _lines(data, offsets)
    pick = np.flatnonzero(n >= MIN_WORDS)
    return h, first[pick], n[pick], text[pick], number[pick]


def _char_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same for lines of at most CHAR_WORDS words, with characters (of the words, joined by one space) instead of words."""
    _, first, n, text, number = _lines(data, offsets)
    starts, ends, _ = word_spans(data, offsets)
    pick = np.flatnonzero((n > 0) & (n <= CHAR_WORDS))
    low, starts, ends = LOWER[data].tobytes(), starts.tolist(), ends.tolist()
    lines = [b" ".join(low[starts[i] : ends[i]] for i in range(a, a + k)).decode() for a, k in zip(first[pick].tolist(), n[pick].tolist(), strict=True)]
    size = np.array([len(x) for x in lines], np.int64)
    h = mix(np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(U64) ^ _OTHER)
    long = np.flatnonzero(size >= MIN_WORDS)
    return h, (np.cumsum(size) - size)[long], size[long], text[pick][long], number[pick][long]


def _half_keys(units):
    """Half keys of the distinct lines of each slice, with the line's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                h, first, n, _, _ = units(*packed(part.column(0)))
                whole, once = np.unique(span_hashes(h, first, first + n), return_index=True)
                key = _keys(h, first[once], n[once])
                valid = np.ones(key.shape, bool)
                valid[n[once] == MIN_WORDS, 2:] = False  # half of four words is no key for five
                yield pa.RecordBatch.from_arrays([pa.array(key[valid].view(np.int64)), pa.array(np.repeat(whole, 4).reshape(-1, 4)[valid].view(np.int64))], names=["_key", "_h"])

    return run


def _some_words(units, wanted):
    """Hashes of the words (or characters) of the lines that `wanted` marks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                h, first, n, text, number = units(*packed(part.column(1)))
                pick = np.flatnonzero(wanted(h, first, n)) if len(n) else np.zeros(0, np.int64)
                raw = [h[a : a + k].tobytes() for a, k in zip(first[pick].tolist(), n[pick].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text[pick])), pa.array(number[pick], pa.int32()), pa.array(raw, pa.binary())], names=["_doc", "_line", "_words"])

    return run


def variants(h: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each line (n words from `first` on): hashes of the whole and of it without each word; the line's index; the place (-1: whole)."""
    total = np.zeros(len(h) + 1, U64)
    p, inv = powers(len(h) + 1), inverse_powers(len(h) + 1)
    np.cumsum(h * p[:-1], out=total[1:])
    line = np.repeat(np.arange(len(n)), n)
    at = ragged(first, n)
    begin, end = first[line], (first + n)[line]
    left = (total[at] - total[begin]) * inv[begin]
    right = (total[end] - total[at + 1]) * inv[begin] * U64(pow(int(p[1]), -1, 1 << 64))
    without = mix((left + right) ^ ((n[line] - 1).astype(U64) << U64(48)))
    whole = mix(((total[first + n] - total[first]) * inv[first]) ^ (n.astype(U64) << U64(48)))
    return np.concatenate([whole, without]), np.concatenate([np.arange(len(n)), line]), np.concatenate([np.full(len(n), -1), at - begin])


def within_one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two word sequences are at most one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    if not len(differ):
        return True
    i = int(differ[0])
    if len(a) == len(b):
        return bool((a[i + 1 :] == b[i + 1 :]).all())
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return bool((a[i + 1 :] == b[i:]).all())


def _kept_words(texts: DataFrame, distinct: DataFrame, units, wanted) -> DataFrame:
    words = texts.mapInArrow(_some_words(units, wanted), "_doc long, _line int, _words binary")
    return written(words.hint("merge").join(distinct.select("_doc", "_line"), ["_doc", "_line"], "left_semi").dropDuplicates(["_doc", "_line"]), "words")


def _verified(pairs: DataFrame, words: DataFrame, verify) -> DataFrame:
    """Those of the pairs (_doc, _line, _doc2, _line2) that `verify` lets pass."""
    pair = pairs.join(words, ["_doc", "_line"]).join(words.select(F.col("_doc").alias("_doc2"), F.col("_line").alias("_line2"), F.col("_words").alias("_words2")), ["_doc2", "_line2"])
    return written(pair.select("_doc", "_line", "_doc2", "_line2", "_words", "_words2").mapInArrow(verify, PAIR), "edits")


def _one_edit(texts: DataFrame, distinct: DataFrame, units, keyed: DataFrame) -> DataFrame:
    """Lines that differ from an earlier one by one word (or character), with the earliest such line. keyed: half keys and lines' hashes."""
    place = F.struct("_doc", "_line")
    halves = repeated_slots(keyed.groupBy("_key").agg(F.min("_h").alias("_a"), F.max("_h").alias("_b")).where("_a != _b"), "_key")
    words = _kept_words(texts, distinct, units, lambda h, first, n: in_slots(halves.value, _keys(h, first, n).reshape(-1)).reshape(-1, 4).any(1))
    twice = repeated_slots(words.mapInArrow(_hashes, "_v long, _n long").groupBy("_v").agg(F.sum("_n").alias("_n")).where("_n > 1"), "_v")
    spread = written(words.mapInArrow(_emit(twice), "_v long, _place int, _doc long, _line int, _whole boolean"), "variants")
    cut = spread.where("not _whole")
    swapped = cut.groupBy("_v", "_place").agg(F.min(place).alias("_best"), F.max(place).alias("_last")).where("_best != _last").select("_v", "_place", "_best")
    by_swap = cut.join(swapped, ["_v", "_place"]).select("_doc", "_line", "_best")
    whole = spread.where("_whole").groupBy("_v").agg(F.min(place).alias("_best"))
    by_cut = cut.join(whole, "_v").select("_doc", "_line", "_best")
    longer = cut.groupBy("_v").agg(F.min(place).alias("_best"))
    by_whole = spread.where("_whole").join(longer, "_v").select("_doc", "_line", "_best")
    best = by_swap.union(by_cut).union(by_whole).groupBy("_doc", "_line").agg(F.min("_best").alias("_best")).where(F.col("_best") < place)
    checked = _verified(best.select("_doc", "_line", F.col("_best._doc").alias("_doc2"), F.col("_best._line").alias("_line2")), words, _verify)
    release(words, spread)
    return checked


def _more_edits(texts: DataFrame, distinct: DataFrame, found: DataFrame) -> DataFrame:
    """Lines of ten words or more, not among `found`, that have an earlier line within a fifth of the longer one's words."""
    place = F.struct("_doc", "_line")
    pieces = repeated_slots(texts.select("_text").mapInArrow(_piece_keys, "_key long"), "_key")
    grams = texts.select("_text").mapInArrow(_gram_keys(pieces), "_key long, _h long")
    shared = repeated_slots(grams.groupBy("_key").agg(F.min("_h").alias("_a"), F.max("_h").alias("_b")).where("_a != _b"), "_key")

    def wanted(h, first, n):
        key, line, _, _ = word_grams(h, first, n)
        has = np.zeros(len(n), bool)
        has[line[in_slots(shared.value, key)]] = True
        return has

    words = _kept_words(texts, distinct, _word_units, wanted)
    spread = written(words.mapInArrow(_emit_grams(shared), "_v long, _at int, _n int, _piece boolean, _doc long, _line int"), "pieces")
    first = spread.groupBy("_v").agg(F.min(place).alias("_best"), F.max(place).alias("_last"), F.bool_or("_piece").alias("_cut")).where("_cut and _best != _last")
    open_ = spread.join(found.select("_doc", "_line").distinct(), ["_doc", "_line"], "left_anti")
    early = open_.join(first.select("_v", "_best"), "_v").where(F.col("_best") < place).select("_doc", "_line", F.col("_best._doc").alias("_doc2"), F.col("_best._line").alias("_line2")).distinct()
    near = _verified(early, words, _verify_share)
    left = open_.join(near.select("_doc", "_line").distinct(), ["_doc", "_line"], "left_anti")
    other = spread.select("_v", *[F.col(c).alias(f"{c}2") for c in ("_at", "_n", "_piece", "_doc", "_line")])
    before = F.struct("_doc2", "_line2") < place
    close = f"abs(_at - _at2) <= int(greatest(_n, _n2) div {SHARE}) and abs(_n - _n2) <= int(greatest(_n, _n2) div {SHARE})"
    longer = left.where("_piece").join(other, "_v").where(before & F.expr(f"_n >= _n2 and {close}"))
    shorter = left.join(other.where("_piece2"), "_v").where(before & F.expr(f"_n <= _n2 and {close}"))
    names = ["_doc", "_line", "_doc2", "_line2"]
    late = _verified(longer.select(*names).union(shorter.select(*names)).distinct(), words, _verify_share)
    release(words, spread)
    return near.union(late)


def removed_lines(docs: DataFrame, *, short: bool = False, whole: bool = False) -> DataFrame:
    """Rows (_doc, _lines): documents that lose lines, and the numbers of those lines, ascending."""
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text")).where("_doc is not null and _text is not null")
    place = F.struct("_doc", "_line")
    lines = written(texts.mapInArrow(_places, "_doc long, _line int, _h long, _g long, " + ", ".join(f"{k} long" for k in KEYS)), "places")
    distinct = lines.groupBy("_h", "_g").agg(F.min(F.struct("_doc", "_line", *KEYS)).alias("_first")).select("_h", "_g", "_first.*")
    distinct = written(distinct, "lines")
    halves = distinct.select("_h", F.explode(F.array_compact(F.array(*KEYS))).alias("_key"))
    distinct = distinct.select("_h", "_g", "_doc", "_line")
    checked = _one_edit(texts, distinct, _word_units, halves)
    if short or whole:
        checked = checked.union(_one_edit(texts, distinct, _char_units, texts.select("_text").mapInArrow(_half_keys(_char_units), "_key long, _h long")))
    if whole:
        checked = checked.union(_more_edits(texts, distinct, checked))
    if short or whole:
        checked = checked.groupBy("_doc", "_line").agg(F.min(F.struct("_doc2", "_line2")).alias("_b")).select("_doc", "_line", "_b.*")
    ends = distinct.join(checked, ["_doc", "_line"], "left").select("_h", "_g", F.struct(F.coalesce("_doc2", "_doc").alias("_doc"), F.coalesce("_line2", "_line").alias("_line")).alias("_keep"))
    gone = lines.select("_h", "_g", "_doc", "_line").join(ends, ["_h", "_g"]).where(F.col("_keep") < place).select("_doc", "_line")
    out = written(gone.groupBy("_doc").agg(F.sort_array(F.collect_set("_line")).alias("_lines")), "gone")
    release(lines)
    return out


def word_grams(h: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the runs of three and four words that can hold a whole piece; the line's index, the place, and whether it is a piece."""
    out = []
    for size, low, high in ((3, 8, 15), (4, 10, 1 << 62)):
        line = np.flatnonzero((n >= low) & (n <= high))
        times = n[line] - size + 1
        at, line = ragged(np.zeros(len(line), np.int64), times), np.repeat(line, times)
        piece = (at % size == 0) & (n[line] >= 10) & (np.isin(n[line], (10, 11, 15)) == (size == 3))
        out.append((mix(span_hashes(h, first[line] + at, first[line] + at + size) ^ U64(size)), line, at, piece))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _piece_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            key, _, _, piece = word_grams(*_word_units(*packed(part.column(0)))[:3])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(key[piece]).view(np.int64))], names=["_key"])


def _gram_keys(cells):
    """Runs that may equal a piece, each with the lowest and the highest hash of its lines in the slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                h, first, n, _, _ = _word_units(*packed(part.column(0)))
                key, line, _, _ = word_grams(h, first, n)
                pick = np.flatnonzero(in_slots(cells.value, key))
                key, whole = key[pick], span_hashes(h, first, first + n)[line[pick]].view(np.int64)
                order = np.lexsort((whole, key))
                key, whole = key[order], whole[order]
                fresh = np.ones(len(key) + 1, bool)
                fresh[1:-1] = key[1:] != key[:-1]
                low, high = np.flatnonzero(fresh[:-1]), np.flatnonzero(fresh[1:])
                both = np.concatenate([low, high[whole[high] != whole[low]]])
                yield pa.RecordBatch.from_arrays([pa.array(key[both].view(np.int64)), pa.array(whole[both])], names=["_key", "_h"])

    return run


def _emit_grams(cells):
    """The runs that another line may share, with their place and line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_words", 1 << 20):
                data, offsets = packed(part.column(2))
                n = np.diff(offsets) // 8
                key, line, at, piece = word_grams(np.frombuffer(data.tobytes(), U64), offsets[:-1] // 8, n)
                p = np.flatnonzero(in_slots(cells.value, key))
                index = pa.array(line[p])
                yield pa.RecordBatch.from_arrays([pa.array(key[p].view(np.int64)), pa.array(at[p], pa.int32()), pa.array(n[line[p]], pa.int32()), pa.array(piece[p]), part.column(0).take(index), part.column(1).take(index)], names=["_v", "_at", "_n", "_piece", "_doc", "_line"])

    return run


def within_share(pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Whether the word edits of each pair are at most the longer one's words divided by SHARE; many pairs at a time, along a band."""
    ok = np.zeros(len(pairs), bool)
    pairs = [(a, b) if len(a) >= len(b) else (b, a) for a, b in pairs]
    size = np.array([(len(a), len(b)) for a, b in pairs], np.int64).reshape(-1, 2)
    some = np.flatnonzero(size[:, 0] - size[:, 1] <= size[:, 0] // SHARE)
    some = some[np.argsort(-size[some, 0], kind="stable")]
    while len(some):
        m = int(size[some[0], 0])
        k = m // SHARE
        now, some = np.split(some, [max(1, CELLS // (m + 2 * k + 1))])
        x = np.zeros((len(now), m), U64)
        y = np.zeros((len(now), m + 2 * k + 1), U64)
        for r, i in enumerate(now.tolist()):
            x[r, : size[i, 0]] = pairs[i][0]
            y[r, k : k + size[i, 1]] = pairs[i][1]
        step = np.arange(2 * k + 1, dtype=np.int32)
        row = np.broadcast_to(np.where(step >= k, step - k, 2 * m), (len(now), len(step))).astype(np.int32)
        end = size[now, 1] - size[now, 0] + k
        for i in range(1, m + 1):
            new = row + (y[:, i - 1 : i + 2 * k] != x[:, i - 1 : i])
            np.minimum(new[:, :-1], row[:, 1:] + 1, out=new[:, :-1])
            new[:, : max(0, k - i)] = 2 * m
            row = np.minimum.accumulate(new - step, axis=1) + step
            done = np.flatnonzero(size[now, 0] == i)
            if len(done):
                ok[now[done]] = row[done, end[done]] <= i // SHARE
    return ok


def _verify_share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(np.frombuffer(a.as_py(), U64), np.frombuffer(b.as_py(), U64)) for a, b in zip(batch.column(4), batch.column(5), strict=True)]
        yield batch.filter(pa.array(within_share(pairs), pa.bool_())).select(["_doc", "_line", "_doc2", "_line2"])


def _neighbourhood(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = packed(part.column(2))
    return variants(np.frombuffer(data.tobytes(), U64), offsets[:-1] // 8, np.diff(offsets) // 8)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all variants, counted within each slice."""
    for batch in batches:
        for part in slices(batch, "_words", 1 << 20):
            value, times = np.unique(_neighbourhood(part)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times)], names=["_v", "_n"])


def _emit(cells):
    """The variants that occur more than once, with their line and the place left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_words", 1 << 20):
                v, line, place = _neighbourhood(part)
                p = np.flatnonzero(in_slots(cells.value, v))
                index = pa.array(line[p])
                yield pa.RecordBatch.from_arrays([pa.array(v[p].view(np.int64)), pa.array(place[p], pa.int32()), part.column(0).take(index), part.column(1).take(index), pa.array(place[p] < 0)], names=["_v", "_place", "_doc", "_line", "_whole"])

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within_one_edit(np.frombuffer(a.as_py(), U64), np.frombuffer(b.as_py(), U64)) for a, b in zip(batch.column(4), batch.column(5), strict=True)]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["_doc", "_line", "_doc2", "_line2"])


def without_lines(text: str, lines: list[int]) -> str:
    """The text without the lines of these numbers."""
    gone = set(lines)
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)


def dedup_lines(docs: DataFrame, *, short: bool = False, whole: bool = False, n_lines: str = "_n_lines", n_removed: str = "_n_removed") -> DataFrame:
    """docs with every removed line and its line break taken out of `text`; all other columns and all rows stay.

    short: with one character edit in short lines; whole: also with the bound that grows with the line. Lines without words stay. Rows
    whose id or text is null stay as they are; a text that loses every line becomes empty. Rows of one id count as one document. Empty
    tables give empty ones; extra columns may have any name but those of the two counts that are added.
    """
    place, at, key = free_name(docs, "_lines"), docs.columns.index("text"), free_name(docs, "_gone_doc")
    lists = removed_lines(docs, short=short, whole=whole).select(F.col("_doc").alias(key), F.col("_lines").alias(place))
    joined = docs.hint("merge").join(lists, docs["doc_id"].cast("long") == F.col(key), "left").drop(key)
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, gone = batch.column(at), batch.column(batch.num_columns - 1)
            data, offsets = packed(column)
            breaks = np.concatenate([[0], np.cumsum(data == 10)])
            total = np.where(np.asarray(column.is_valid()), breaks[offsets[1:]] - breaks[offsets[:-1]] + 1, 0)
            number = np.asarray(gone.value_lengths().fill_null(0)).astype(np.int64)
            some = np.flatnonzero((number > 0) & (total > 0))
            if len(some):
                mask = np.zeros(batch.num_rows, bool)
                mask[some] = True
                fresh = [without_lines(column[i].as_py(), gone[i].as_py()) for i in some.tolist()]
                column = pc.replace_with_mask(column, pa.array(mask), pa.array(fresh, column.type))
            else:
                number[:] = 0
            columns = [column if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(np.where(total > 0, number, 0), pa.int64())], names=schema.names)
            trim()

    return joined.mapInArrow(rebuild, schema)
