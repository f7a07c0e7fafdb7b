"""Packing of token sequences into as few fixed-size ones as possible, by linear grouping.

Only how many pieces have each length decides the plan, and lengths are whole numbers up to the capacity: so a histogram of at most
`capacity` rows, however many documents there are, is all that the plan is made from, and it is a table of at most some thousand rules of
the kind "the pieces of length l ranked a to b go to the sequences from s on, at offset o". Pieces are ranked within their length and
placed by the rules where they lie.

The plan: pieces that fill a sequence are alone. Large lengths are sorted and cut into groups of equal cardinality; all of a group count
as its largest. How often each configuration of these few sizes is used is a linear programme, solved by column generation; rounded
down, and what is left is put together largest first. Actual pieces take the places of their group, longest first, so runs of sequences
hold equal lengths. Small pieces then go, longest first, where they fit best; only what fits nowhere opens new sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.middle import BLANK
from cytoframe.llm.shared import binary_column, free_name, packed, ragged, slices, trim, written

CAPACITY, END_ID = 4096, 1
GROUPS = 96  # of large lengths
LARGE_PARTS = (3, 4, 8, 16, 2)  # lengths above such a part of the capacity count as large; the first choice that gives the fewest sequences
CACHE_WORDS, CACHE_BYTES, CACHED_WORD = 500_000, 16 << 20, 256  # words that a worker keeps, their bytes, and the longest of them
LEARNT = 4_000
SLICE = 2 << 20


_UPPER, _LETTER, _STOP = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = True
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[*b".,;:!?"]] = True


class WordTokens:
    """The tokenizer library behind a cache of words, for tokenizers that lower-case and treat white space as nothing but a boundary.

    Words are runs of other bytes than 0x20 and 0x09 to 0x0D. Before the split, a capital that an ASCII character follows becomes small
    (its lower case is the same with and without what follows; before other characters it could be composed), except in texts that hold
    the beginning of a special token, and a stop behind a letter is set apart, since no token spans the two: that makes far fewer
    different words. Plain words go to the library's model by themselves, others through the whole tokenizer. Tokenizers that give blanks
    or capitals a meaning are refused.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        whole = lambda s: self.library.encode(s, add_special_tokens=False).ids
        if whole(" aB  1\n\t.c? ") != [i for w in ("ab", "1", ".c", "?") for i in whole(w)]:
            raise ValueError("the tokenizer gives blanks or capitals a meaning; words cannot be encoded by themselves")
        self.marks = [t.content.encode()[:2] for t in self.library.get_added_tokens_decoder().values()]
        if any(_STOP[list(t.content.encode())].any() for t in self.library.get_added_tokens_decoder().values()):
            raise ValueError("a special token holds a stop")
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.forget()

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of a-z alone, and how many each has: many words in one text."""
        found = self.model.encode_batch([" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)], add_special_tokens=False)
        size = [np.bincount(np.array(e.word_ids, np.int64), minlength=min(1000, len(words) - 1000 * i)) for i, e in enumerate(found)]
        return np.array(list(chain.from_iterable(e.ids for e in found)), np.int64), np.concatenate(size)

    def _any(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(found)), np.int64), np.fromiter(map(len, found), np.int64, len(found))

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.bytes = self.held = 0
        self.start, self.size, self.pool = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.int32)

    def _learn(self, words: list[bytes]) -> None:
        """Takes in words, some thousands at a time: the library's answers are far larger than the ids in them."""
        for i in range(0, len(words), LEARNT):
            self._learn_some(words[i : i + LEARNT])

    def _learn_some(self, words: list[bytes]) -> None:
        text = [w.decode() for w in words]
        plain = [w.isascii() and w.isalpha() and w.islower() for w in text]
        parts = [f([w for w, p in zip(text, plain, strict=True) if p == kind]) for f, kind in ((self._plain, True), (self._any, False)) if kind in plain]
        words = [w for kind in (True, False) for w, p in zip(words, plain, strict=True) if p == kind]
        ids, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        a, b, c = len(self.known), len(self.known) + len(words), self.held + len(ids)
        while b > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while c > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.start[a:b], self.size[a:b] = self.held + np.cumsum(size) - size, size
        self.pool[self.held : c] = ids
        self.known.update(zip(words, range(a, b), strict=True))
        self.held = c
        self.bytes += sum(map(len, words))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of packed texts, one after the other, and how many each text has."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        if not any(m in data.tobytes() for m in self.marks):
            small = _UPPER[data]
            small[:-1] &= data[1:] < 128
            data = data | small.view(np.uint8) << 5
        word = ~BLANK[data]
        begins = word.copy()
        begins[1:] &= ~word[:-1] | (_STOP[data[1:]] & _LETTER[data[:-1]])
        edges = offsets[:-1][offsets[:-1] < len(data)]
        begins[edges] |= word[edges]
        first = np.flatnonzero(begins)
        place = np.cumsum(word)
        to = np.append(place[first] - 1, place[-1])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(to), pa.py_buffer(np.ascontiguousarray(data[word]))]).dictionary_encode()
        words, code = words.dictionary.to_pylist(), words.indices.to_numpy()
        at = np.fromiter((self.known.get(w, -1) for w in words), np.int64, len(words))
        fresh = [words[i] for i in np.flatnonzero(at < 0)]
        if len(self.known) + len(fresh) > CACHE_WORDS or self.bytes > CACHE_BYTES:
            self.forget()
            fresh = words
        if short := [w for w in fresh if len(w) <= CACHED_WORD]:
            self._learn(short)
        before = self.held, self.bytes
        if long := [w for w in fresh if len(w) > CACHED_WORD]:
            self._learn(long)
        if fresh:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        at = at[code]
        size = self.size[at]
        ids = self.pool[ragged(self.start[at], size)]
        for w in long:  # of no use to later texts
            del self.known[w]
        self.held, self.bytes = before
        to = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(first, offsets)]
        return ids, np.diff(to)


_tokens: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The worker's own encoder."""
    if path not in _tokens:
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` with piece (from 0), start, length and ids (little-endian uint32) of every piece of every document.

    A document is its whole text's ids and end_id; null texts count as empty (end_id alone). Documents longer than the capacity are cut
    into pieces of that length, the last one may be shorter; no other is cut. Repeated rows are documents of their own; other columns are
    not looked at. No shuffle.
    """
    fields = [docs.schema[c] for c in keep] + [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
    names = [f.name for f in fields]
    text = free_name(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer)
        for batch in batches:
            for part in slices(batch, text, SLICE):
                ids, counts = tokens.encode(*packed(part.column(0)))
                out = np.full(len(ids) + len(counts), end_id, "<u4")
                out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
                size = counts + 1
                number = -(-size // capacity)
                owner = np.repeat(np.arange(len(size)), number)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                start = piece * capacity
                length = np.minimum(size[owner] - start, capacity)
                column = binary_column(out.view(np.uint8), np.concatenate([[0], 4 * np.cumsum(length)]))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(owner)) for c in part.columns[1:]), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), column], names=names)
        tokens.forget()  # workers live on, and more of them than run at a time
        trim()

    return docs.select(F.col(text_column).alias(text), *keep).mapInArrow(run, T.StructType(fields))


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size fit into the capacity with the largest total value."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for k in np.flatnonzero(values > 0):
        s = int(sizes[k])
        for _ in range(capacity // s):
            more = best[: capacity + 1 - s] + values[k]
            better = np.flatnonzero(more > best[s:] + 1e-12)
            if not len(better):
                break
            best[better + s] = more[better]
            taken[better + s] = k
    out, left = np.zeros(len(sizes)), int(np.argmax(best))
    while left > 0 and taken[left] >= 0:
        out[taken[left]] += 1
        left -= int(sizes[taken[left]])
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (rows) of a basic solution of the linear programme, and how often each is used.

    Ends when the programme's own bound shows that less than one sequence could still be saved.
    """
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    used = demand / np.diag(basis)
    while True:
        price = np.linalg.solve(basis, np.ones(k))
        new = best_configuration(sizes, price, capacity)
        worth = float(new @ price)
        if worth <= 1 + 1e-9 or used.sum() * (1 - 1 / worth) < 1:
            return basis, used
        step = np.linalg.solve(basis.T, new)
        ratio = np.where(step > 1e-9, used / np.maximum(step, 1e-9), np.inf)
        out = int(np.argmin(ratio))
        used = np.maximum(used - ratio[out] * step, 0)
        used[out] = ratio[out]
        basis[out] = new


class _Runs:
    """Runs of sequences with equal room, by room: (first sequence, one past the last)."""

    def __init__(self, capacity: int):
        self.by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.some = np.zeros(capacity + 1, bool)

    def add(self, room: int, first: int, stop: int) -> None:
        if stop > first:
            self.by_room[room].append((first, stop))
            self.some[room] = True

    def tightest(self, least: int) -> int:
        """The smallest room of at least so much, -1 if there is none."""
        at = int(np.argmax(self.some[least:])) + least
        return at if at < len(self.some) and self.some[at] else -1

    def take(self, room: int) -> tuple[int, int]:
        run = self.by_room[room].pop()
        self.some[room] = bool(self.by_room[room])
        return run


def plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS, large_part: float = 4) -> tuple[np.ndarray, int]:
    """Rules (length, first rank, one past the last, first sequence, pieces a sequence, offset) for all pieces, and the number of sequences.

    histogram[l]: pieces of length l, 1 to capacity. A rule puts the pieces of its ranks into consecutive sequences, so many into each,
    one behind the other from the offset on.
    """
    rules: list[tuple[int, int, int, int, int, int]] = []
    sequences = int(histogram[capacity])
    if sequences:
        rules.append((capacity, 0, sequences, 0, 1, 0))
    runs = _Runs(capacity)
    lengths = np.flatnonzero(histogram[:capacity])[::-1]
    large = lengths[lengths > capacity / large_part]
    stop = np.cumsum(histogram[large])
    begin = stop - histogram[large]
    total = int(stop[-1]) if len(stop) else 0

    def placed(slots: list[tuple[int, int]], number: int) -> None:
        """`number` new sequences, each slot filled with the pieces (in order of length) from its first on; a slot may run out."""
        nonlocal sequences
        edges = {0, number}
        for first, last in slots:
            edges.add(min(number, max(0, last - first)))
            inside = stop[(stop > first) & (stop < min(last, first + number))] - first
            edges.update(inside.tolist())
        edges = sorted(edges)
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            offset = 0
            for first, last in slots:
                if first + a >= last:
                    continue
                i = int(np.searchsorted(stop, first + a, side="right"))
                rank = first + a - int(begin[i])
                rules.append((int(large[i]), rank, rank + b - a, sequences + a, 1, offset))
                offset += int(large[i])
            if offset:
                runs.add(capacity - offset, sequences + a, sequences + b)
        sequences += number

    if total:
        bounds = np.unique(np.minimum(np.arange(groups + 1) * -(-total // groups), total))
        size = large[np.searchsorted(stop, bounds[:-1], side="right")]
        head = np.flatnonzero(np.concatenate([[True], size[1:] != size[:-1]]))  # groups of one size are one
        size, low = size[head], bounds[:-1][head]
        high = np.append(low[1:], total)
        at = low.copy()
        basis, used = configurations(size, (high - low).astype(float), capacity)
        for config, times in zip(basis, np.floor(used + 1e-6).astype(np.int64), strict=True):
            slots = []
            for k in np.flatnonzero(config):
                for _ in range(int(config[k])):
                    end = min(int(at[k]) + int(times), int(high[k]))
                    slots.append((int(at[k]), end))
                    at[k] = end
            most = max((b - a for a, b in slots), default=0)
            if most:
                placed(slots, most)
        # what rounding down leaves, largest first into the tightest of the sequences begun here
        open_: list[tuple[int, list[tuple[int, int]]]] = []
        for k in range(len(size)):
            for item in range(int(at[k]), int(high[k])):
                length = int(large[np.searchsorted(stop, item, side="right")])
                fits = [j for j, (room, _) in enumerate(open_) if room >= length]
                j = min(fits, key=lambda j: open_[j][0], default=None)
                if j is None:
                    open_.append((capacity - length, [(item, item + 1)]))
                else:
                    room, slots = open_[j]
                    open_[j] = (room - length, [*slots, (item, item + 1)])
        for _, slots in open_:
            placed(slots, 1)
    for length in lengths[len(large) :].tolist():
        rank, number = 0, int(histogram[length])
        while rank < number:
            room = runs.tightest(length)
            if room < 0:
                fresh = -(-(number - rank) // (capacity // length))
                runs.add(capacity, sequences, sequences + fresh)
                sequences += fresh
                room = capacity
            first, last = runs.take(room)
            each = room // length
            full = min(last - first, (number - rank) // each)
            if full:
                rules.append((length, rank, rank + full * each, first, each, capacity - room))
                rank += full * each
                runs.add(room - each * length, first, first + full)
                first += full
            rest = min(number - rank, each)
            if rest and first < last:
                rules.append((length, rank, rank + rest, first, rest, capacity - room))
                rank += rest
                runs.add(room - rest * length, first, first + 1)
                first += 1
            runs.add(room, first, last)
    return np.array(sorted(rules), np.int64).reshape(-1, 6), sequences


def best_plan(histogram: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[np.ndarray, int]:
    """The plan of the fewest sequences over LARGE_PARTS; none is tried after one that fills all sequences but the last.

    Many small pieces fill whatever room large ones leave, so that few lengths should count as large; without them, grouping should
    reach further down. With a part of 2 every configuration is a single piece and all else is best fit.
    """
    least = -(-int((histogram * np.arange(capacity + 1)).sum()) // capacity)
    best = None
    for part in LARGE_PARTS:
        if best is None or best[1] > least:
            found = plan(histogram, capacity, groups, part)
            best = found if best is None or found[1] < best[1] else best
    return best


def packed_sequences(rows: DataFrame, *, capacity: int = CAPACITY, groups: int = GROUPS, length: str = "length") -> DataFrame:
    """All columns of rows with sequence_id and offset: the sequence that each piece lies in, and its place there, without gaps.

    Lengths are whole numbers from 1 to the capacity, else an error. Which of several pieces of one length goes where depends on where
    they are read, so repeated runs may differ in it, not in the number of sequences. Column names of rows are kept, so rows must not
    have the two new ones. An empty table gives an empty one.

    Pieces are counted by part (what one task read) and length, and ranked by adding up the counts of the parts before: the driver sees
    the lengths' histogram, tasks the rules, both bounded by the capacity.
    """
    part, nth, base, rank = (free_name(rows, c) for c in ("_part", "_nth", "_base", "_rank"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, own = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy(zero_copy_only=False)
            if len(size) and not (np.issubdtype(size.dtype, np.integer) and 1 <= size.min() and size.max() <= capacity):
                raise ValueError(f"lengths must be whole numbers from 1 to {capacity}")
            order = np.argsort(size, kind="stable")
            count = np.bincount(size, minlength=capacity + 1)
            place = np.empty(len(size), np.int64)
            place[order] = np.arange(len(size)) - np.repeat(np.cumsum(count) - count, count)
            out = seen[size] + place
            seen += count
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), own, np.int32)), pa.array(out)], names=[*batch.schema.names, part, nth])

    fields = [*rows.schema.fields, T.StructField(part, T.IntegerType()), T.StructField(nth, T.LongType())]
    ranked = written(rows.mapInArrow(number, T.StructType(fields)), "pieces")
    each = written(ranked.groupBy(part, length).agg((F.max(nth) + 1).alias("_n")), "counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for r in each.groupBy(length).agg(F.sum("_n").alias("_n")).collect():  # at most `capacity` rows
        histogram[r[0]] = r[1]
    rules, _ = best_plan(histogram, capacity, groups)
    shared = rows.sparkSession.sparkContext.broadcast(rules)
    before = each.select(part, length, (F.sum("_n").over(Window.partitionBy(length).orderBy(part)) - F.col("_n")).alias(base))
    names = [*rows.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        key = r[:, 0] << 48 | r[:, 1]
        for batch in batches:
            size = batch.column(batch.schema.get_field_index(length)).to_numpy().astype(np.int64)
            at = batch.column(batch.schema.get_field_index(rank)).to_numpy()
            rule = r[np.searchsorted(key, size << 48 | at, side="right") - 1]
            number = at - rule[:, 1]
            columns = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != rank]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rule[:, 3] + number // rule[:, 4]), pa.array(rule[:, 5] + number % rule[:, 4] * size)], names=names)

    found = ranked.join(before, [part, length]).select(*rows.columns, (F.col(nth) + F.col(base)).alias(rank))
    return found.mapInArrow(place, T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """Rows (sequence_id, n_tokens, ids): the token ids of every sequence. A sequence has at most as many pieces as its capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    rows = placed.groupBy("sequence_id").agg(parts.alias("_parts"))
    joined = F.expr("aggregate(_parts, cast('' as binary), (a, x) -> concat(a, x.ids))")
    return rows.select("sequence_id", joined.alias("ids")).select("sequence_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")
