"""Byte-level BPE: vectorised pre-tokenising, merges by a segment tree over pair ranks, and decoding.

Texts are split as the byte-level pattern does ('s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+).
Each pre-token is a row of a segment tree whose leaves are the ranks of its adjacent pairs: the root names the leftmost pair of
lowest rank, and a merge changes three leaves and the nodes above them. Rows of equal tree size are merged together in numpy;
a pre-token of over 256 bytes gets a tree of its own. Pre-tokens already seen by a worker come from a bounded table, which compares
their bytes on every hit, so two pre-tokens of one hash never share ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.hashing import U64, mix
from cytoframe.llm.shared import packed, ragged, slices

SPACE, LETTER, NUMBER, OTHER = range(4)
NONE = np.int64(1) << 40
LONG = 256
CACHE_WORDS = 1_000_000  # pre-tokens that a worker keeps at most,
CACHE_LANES = 4_000_000  # and eight-byte pieces of them
SLICE = 1 << 20
CODE_POINTS = 1 << 13


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of each code point, as the library's own pattern sees it under \\s, \\p{L} and \\p{N}.

    A first guess comes from `regex`, whose Unicode tables may be of another age. All characters of a guessed class in one text are cut
    by the library wherever its class changes, so one look at each piece sets the guess right. Texts of CODE_POINTS at a time: one of all
    characters takes a worker hundreds of MB.
    """
    import regex
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    kind = np.full(0x110000, OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800, dtype=np.int32), np.arange(0xE000, 0x110000, dtype=np.int32)])
    pieces = lambda some: (some[i : i + CODE_POINTS] for i in range(0, len(some), CODE_POINTS))
    text = lambda some: some.astype("<u4").tobytes().decode("utf-32-le")
    for back in pieces(points):
        for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
            for m in regex.finditer(pattern, text(back)):
                kind[back[m.start() : m.end()]] = value

    def look(c: str) -> int:
        for probe, value in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(split(probe + c)) == 1:
                return value
        return SPACE

    for c in map(chr, points[kind[points] == SPACE].tolist()):
        kind[ord(c)] = look(c)
    for whole in [points[kind[points] == value] for value in (LETTER, NUMBER, OTHER)]:
        for own in pieces(whole):
            for _, (first, stop) in split(text(own)):
                kind[own[first:stop]] = look(chr(own[first]))
    return kind


def byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte: that of the character it belongs to."""
    kind = character_classes()
    out = kind[:256][np.where(data < 128, data, 0)]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = [np.concatenate([data, np.zeros(3, np.uint8)])[lead + i].astype(np.int64) for i in range(4)]
        two, three = b[0] < 0xE0, (b[0] >= 0xE0) & (b[0] < 0xF0)
        cp = np.where(two, (b[0] & 31) << 6 | b[1] & 63, np.where(three, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63, (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63))
        c = kind[np.minimum(cp, 0x10FFFF)]
        size = np.where(two, 2, np.where(three, 3, 4))
        for i in range(4):
            has = (size > i) & (lead + i < len(data))
            out[lead[has] + i] = c[has]
    return out


def pretokens(data: np.ndarray, offsets: np.ndarray, special: tuple[bytes, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all pre-tokens in packed texts, and the index of each text's first one (with an end mark)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    whole = []
    raw = data.tobytes() if special else b""
    for mark in special:
        at = 0
        while (at := raw.find(mark, at)) >= 0:
            if edge[at + 1 : at + len(mark)].any():
                at += 1
                continue
            whole.append((at, at + len(mark)))
            at += len(mark)
    for a, b in whole:
        edge[a] = edge[b] = True
    kind = byte_classes(data)
    change = edge[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    start = change.copy()
    run = np.flatnonzero(change & (kind != SPACE) & ~edge[:n])
    run = run[kind[run - 1] == SPACE]
    plain = data[run - 1] == 0x20
    start[run[plain]] = False
    start[run[plain] - 1] = True
    last = run[~plain] - 1
    while len(last):
        inner = (data[last] & 0xC0) == 0x80
        start[last[~inner]] = True
        last = last[inner] - 1
    quote = np.flatnonzero((data == 0x27) & change & start)
    pad = np.concatenate([data, np.zeros(3, np.uint8)])
    cut = np.concatenate([edge, np.ones(3, bool)])
    alone = np.concatenate([change, np.ones(2, bool)])
    quote = quote[alone[quote + 1] & ~cut[quote + 1]]
    one, two = pad[quote + 1], pad[quote + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    pair = (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)) & ~cut[quote + 2]
    quote, size = quote[short | pair], np.where(short, 2, 3)[short | pair]
    start[quote + 1] = False
    after = quote + size
    after = after[after < n]
    after = after[(kind[after] == LETTER) & ~edge[after]]
    start[after] = True
    for a, b in whole:
        start[a + 1 : b] = False
        start[a] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, offsets)


def word_lanes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes in pieces of eight, zero-filled, as numbers; pieces of each word; and a 64-bit hash of each word."""
    pad = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", pad, strides=(1,)).copy()
    count = (lengths + 7) >> 3
    owner = np.repeat(np.arange(len(lengths)), count)
    begin = np.cumsum(count) - count
    place = np.arange(len(owner)) - begin[owner]
    value = eight[starts[owner] + 8 * place]
    left = lengths[owner] - 8 * place
    short = np.flatnonzero(left < 8)
    value[short] &= (U64(1) << (8 * left[short]).astype(U64)) - U64(1)
    h = mix(value + mix(place.astype(U64) + U64(1)))
    return value, count, mix(np.add.reduceat(h, begin) + lengths.astype(U64)) if len(begin) else h


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if len(a) >= n:
        return a
    out = np.empty(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


class Known:
    """Words and their ids: open addressing by hash; bytes are compared, so words of one hash stay apart."""

    def __init__(self):
        self.n = self.lanes = self.size = 0
        self.slots = np.full(1 << 16, -1, np.int32)
        self.keys, self.lane_at, self.lengths = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.id_at, self.id_n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.lane_pool, self.id_pool = np.zeros(0, U64), np.zeros(0, np.int32)

    def _place(self, index: np.ndarray) -> None:
        mask = len(self.slots) - 1
        at = (self.keys[index] & U64(mask)).astype(np.int64)
        while len(index):
            free = self.slots[at] < 0
            self.slots[at[free]] = index[free]
            wait = self.slots[at] != index
            index, at = index[wait], (at[wait] + 1) & mask

    def find(self, keys: np.ndarray, value: np.ndarray, begin: np.ndarray, count: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Index of each word, -1 where it is not known."""
        mask = len(self.slots) - 1
        out = np.full(len(keys), -1, np.int64)
        open_, at = np.arange(len(keys)), (keys & U64(mask)).astype(np.int64)
        while len(open_):
            i = self.slots[at].astype(np.int64)
            some = i >= 0
            open_, at, i = open_[some], at[some], i[some]
            same = np.flatnonzero((self.keys[i] == keys[open_]) & (self.lengths[i] == lengths[open_]))
            hit = np.zeros(len(open_), bool)
            if len(same):
                o, k = open_[same], i[same]
                n = count[o]
                equal = self.lane_pool[ragged(self.lane_at[k], n)] == value[ragged(begin[o], n)]
                hit[same] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
            out[open_[hit]] = i[hit]
            open_, at = open_[~hit], (at[~hit] + 1) & mask
        return out

    def add(self, keys: np.ndarray, value: np.ndarray, begin: np.ndarray, count: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Takes in words that are not known yet; returns their indices."""
        a, b = self.n, self.n + len(keys)
        for name, new in (("keys", keys), ("lengths", lengths), ("lane_at", self.lanes + np.cumsum(count) - count), ("id_at", self.size + np.cumsum(counts) - counts), ("id_n", counts)):
            grown = _grown(getattr(self, name), b)
            grown[a:b] = new
            setattr(self, name, grown)
        lanes = value[ragged(begin, count)]
        self.lane_pool = _grown(self.lane_pool, self.lanes + len(lanes))
        self.lane_pool[self.lanes : self.lanes + len(lanes)] = lanes
        self.id_pool = _grown(self.id_pool, self.size + len(ids))
        self.id_pool[self.size : self.size + len(ids)] = ids
        self.n, self.lanes, self.size = b, self.lanes + len(lanes), self.size + len(ids)
        if 2 * b > len(self.slots):
            self.slots = np.full(1 << (2 * b - 1).bit_length(), -1, np.int32)
            self._place(np.arange(b, dtype=np.int32))
        else:
            self._place(np.arange(a, b, dtype=np.int32))
        return np.arange(a, b)


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file, with the encoder and decoder over them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in visible)}
        self.shown = {b: ord(c) for b, c in shown.items()}
        back = {c: b for b, c in shown.items()}
        self.first = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", ())}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        size = max([*vocab.values(), *self.special.values()]) + 1
        pieces = [b""] * size
        for piece, i in vocab.items():
            pieces[i] = bytes(back[c] for c in piece)
        for piece, i in self.special.items():
            pieces[i] = piece
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_start = np.cumsum(self.piece_length) - self.piece_length
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.known = Known()

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where no merge joins it."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _tree(self, symbols: np.ndarray, sizes: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Merges the rows of `symbols` (sizes symbols each, at most `leaves`); returns all rows' ids and their numbers."""
        rows = len(symbols)
        tree = np.full((rows, 2 * leaves), NONE * leaves, np.int64)
        place = np.arange(leaves)
        if leaves > 1:
            both = place[None, :-1] < sizes[:, None] - 1
            r = self.rank(symbols[:, :-1], symbols[:, 1:])
            tree[:, leaves : 2 * leaves - 1] = np.where(both & (r < NONE), r * leaves + place[:-1], NONE * leaves)
        for level in (1 << i for i in range(leaves.bit_length() - 2, -1, -1)):
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        after = np.where(place[None] + 1 < sizes[:, None], place[None] + 1, leaves)
        before = np.broadcast_to(place - 1, (rows, leaves)).copy()
        live = place[None] < sizes[:, None]
        flat, sym, nxt, prv, alive = tree.reshape(-1), symbols.reshape(-1), after.reshape(-1), before.reshape(-1), live.reshape(-1)
        row = np.arange(rows)
        while len(row):
            root = flat[row * 2 * leaves + 1]
            go = root < NONE * leaves
            row, root = row[go], root[go]
            if not len(row):
                break
            at, base = root % leaves, row * leaves
            gone = nxt[base + at]
            sym[base + at] = self.merged[root // leaves]
            alive[base + gone] = False
            then = nxt[base + gone]
            nxt[base + at] = then
            has = then < leaves
            prv[(base + then)[has]] = at[has]
            ahead = np.full(len(row), NONE * leaves, np.int64)
            r = self.rank(sym[(base + at)[has]], sym[(base + then)[has]])
            ahead[has] = np.where(r < NONE, r * leaves + at[has], NONE * leaves)
            left = prv[base + at]
            has = left >= 0
            r = self.rank(sym[(base + left)[has]], sym[(base + at)[has]])
            flat[(row * 2 * leaves + leaves + gone)] = NONE * leaves
            flat[(row * 2 * leaves + leaves + at)] = ahead
            flat[(row * 2 * leaves + leaves + left)[has]] = np.where(r < NONE, r * leaves + left[has], NONE * leaves)
            top = row * 2 * leaves
            for node, own in ((gone, top), (at, top), (left[has], top[has])):
                node = (node + leaves) >> 1
                for _ in range(leaves.bit_length() - 1):
                    flat[own + node] = np.minimum(flat[own + 2 * node], flat[own + 2 * node + 1])
                    node = node >> 1
        return symbols[live], live.sum(1)

    def _long(self, word: bytes) -> list[int]:
        """The same tree for one long pre-token."""
        sym = self.first[np.frombuffer(word, np.uint8)].tolist()
        n = len(sym)
        leaves = 1 << max(1, (n - 1).bit_length())
        none = int(NONE) * leaves
        rank = {int(k): int(r) for k, r in zip(self.keys, self.ranks, strict=True)} if not hasattr(self, "_ranks") else self._ranks
        self._ranks = rank
        look = lambda a, b, i: none if (r := rank.get(a << 20 | b)) is None else r * leaves + i
        tree = [none] * (2 * leaves)
        for i in range(n - 1):
            tree[leaves + i] = look(sym[i], sym[i + 1], i)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n

        def put(i: int, value: int) -> None:
            i += leaves
            tree[i] = value
            i >>= 1
            while i:
                value = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == value:
                    break
                tree[i] = value
                i >>= 1

        while tree[1] < none:
            r, at = divmod(tree[1], leaves)
            gone = nxt[at]
            then = nxt[gone]
            sym[at], live[gone], nxt[at] = int(self.merged[r]), False, then
            put(gone, none)
            if then < n:
                prv[then] = at
                put(at, look(sym[at], sym[then], at))
            else:
                put(at, none)
            if prv[at] >= 0:
                put(prv[at], look(sym[prv[at]], sym[at], prv[at]))
        return [s for s, keep in zip(sym, live, strict=True) if keep]

    def words(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given pre-tokens, one after the other, and how many each has."""
        counts = np.zeros(len(starts), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        special = np.zeros(len(starts), bool)
        for mark in self.special:
            for i in np.flatnonzero(lengths == len(mark)):
                if data[starts[i] : starts[i] + len(mark)].tobytes() == mark:
                    special[i] = True
                    parts.append((np.array([i]), np.array([self.special[mark]])))
                    counts[i] = 1
        low = 0
        for leaves in (1, 2, 4, 8, 16, 32, 64, 128, LONG):
            pick = np.flatnonzero((lengths > low) & (lengths <= leaves) & ~special)
            low = leaves
            step = max(1, (1 << 20) // leaves)
            for i in range(0, len(pick), step):
                p = pick[i : i + step]
                grid = starts[p][:, None] + np.arange(leaves)
                symbols = self.first[data[np.minimum(grid, len(data) - 1)]]
                ids, counts[p] = self._tree(symbols, lengths[p], leaves)
                parts.append((p, ids))
        for i in np.flatnonzero((lengths > LONG) & ~special):
            ids = np.array(self._long(data[starts[i] : starts[i] + lengths[i]].tobytes()), np.int64)
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        begins = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        for p, ids in parts:
            out[ragged(begins[p], counts[p])] = ids
        return out, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray, encode_words=None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of packed texts, one after the other, and ids per text."""
        starts, first = pretokens(data, offsets, tuple(self.special))
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
        lengths = np.append(starts[1:], len(data))[: len(starts)] - starts
        value, count, key = word_lanes(data, starts, lengths)
        begin = np.cumsum(count) - count
        code, unique = pd.factorize(key)
        seen = np.empty(len(unique), np.int64)
        seen[code[::-1]] = np.arange(len(code))[::-1]
        rep = seen[code]
        fits = count == count[rep]
        twin = np.where(fits, rep, np.arange(len(rep)))
        equal = value == value[ragged(begin[twin], count)]
        differ = np.flatnonzero(~fits | (lengths != lengths[rep]) | ~np.logical_and.reduceat(equal, begin))
        if len(differ):  # words of one hash
            own: dict[bytes, int] = {}
            for i in differ.tolist():
                code[i] = own.setdefault(data[starts[i] : starts[i] + lengths[i]].tobytes(), len(seen) + len(own))
            fresh = np.empty(len(own), np.int64)
            fresh[code[differ[::-1]] - len(seen)] = differ[::-1]
            seen = np.concatenate([seen, fresh])
        if self.known.n + len(seen) > CACHE_WORDS or self.known.lanes > CACHE_LANES:
            self.known = Known()
        word = self.known.find(key[seen], value, begin[seen], count[seen], lengths[seen])
        new = np.flatnonzero(word < 0)
        if len(new):
            pick = seen[new]
            ids, counts = (encode_words or self.words)(data, starts[pick], lengths[pick])
            word[new] = self.known.add(key[pick], value, begin[pick], count[pick], lengths[pick], ids, counts)
        each = self.known.id_n[word][code]
        total = np.concatenate([[0], np.cumsum(each)])
        return self.known.id_pool[ragged(self.known.id_at[word][code], each)].astype(np.int64), np.diff(total[first])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids, one after the other, and the bytes of each id."""
        size = self.piece_length[ids]
        return self.piece_bytes[ragged(self.piece_start[ids], size)], size


@lru_cache(4)
def merges(path: str) -> Merges:
    return Merges(path)


def decimals(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal text of 0 .. size-1, each followed by a comma: bytes, starts, lengths."""
    text = [b"%d," % i for i in range(size)]
    length = np.array([len(x) for x in text], np.int64)
    return np.frombuffer(b"".join(text), np.uint8), np.cumsum(length) - length, length


def as_text(raw: bytes) -> bytes:
    """UTF-8 of what the bytes decode to; invalid sequences become U+FFFD."""
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode("utf-8", "replace").encode()


def encode_decode(docs: DataFrame, tokenizer: str, *, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes every whole text and decodes it again; one row per input row: id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded).

    Null texts count as empty; repeated rows give repeated rows; an empty table gives an empty one; other columns are ignored.
    No shuffle: each task works through its own rows in slices of about 1 MB of text.
    """
    fields = [T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = merges(tokenizer)
        digits, digit_start, digit_length = decimals(len(bpe.piece_length))
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                data, offsets = packed(part.column(1))
                ids, counts = bpe.encode(data, offsets)
                plain, size = bpe.decode(ids)
                to = np.concatenate([[0], np.cumsum(counts)])
                plain_to = np.concatenate([[0], np.cumsum(size)])[to]
                number = digit_length[ids]
                text = digits[ragged(digit_start[ids], number)].tobytes()
                text_to = np.concatenate([[0], np.cumsum(number)])[to]
                raw = plain.tobytes()
                n = len(counts)
                decoded = [as_text(raw[plain_to[i] : plain_to[i + 1]]) for i in range(n)]
                out = [part.column(0), pa.array(counts, pa.int64()), pa.array([hashlib.sha256(text[text_to[i] : max(text_to[i], text_to[i + 1] - 1)]).hexdigest() for i in range(n)]), pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
                if with_ids:
                    out += [pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(ids, pa.int32())), pa.array([d.decode() for d in decoded], pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return docs.select(F.col(id_column), F.col(text_column).alias("_text")).mapInArrow(run, T.StructType(fields))
