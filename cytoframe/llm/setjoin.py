"""Near-duplicate documents: Jaccard join of word shingles by universe partition and pigeonhole.

The universe of shingles is hashed into segments, their number set by a band of set sizes. Two sets of Jaccard similarity 0.8 or
more differ in at most (|x| + |y|) / 9 shingles, so among enough segments some must be equal, or differ in one shingle. For every
band the plan with the least expected cost is taken among exact segments and one-deletion neighbourhoods (`plans`); segments
without shingles give no key, so each set counts the differences that its own segments rule out, and where they do not exceed
the bound, it also takes part in the next, finer plan. The last plan makes each shingle a segment of its own, so no pair is lost:
a pair is covered at the level where the first of the two has enough.

Every candidate is verified on whole shingle sets. In a list of sets under one key, each is compared with the list's first and
with its neighbour; where the list still falls into several components, sets of different components are compared through parity
sketches (whose Hamming distance never exceeds the sets' difference), in blocks, and verified again. So no pair of one component
is multiplied out and no link between components is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.components import connected_components
from cytoframe.llm.hashing import U64, mix, shingle_hashes, word_hashes
from cytoframe.llm.shared import free_name, in_slots, packed, partitions, ragged, release, repeated_slots, slices, written

WIDTH = 5
SHARED, UNION = 80, 100  # similar if UNION * |x & y| >= SHARED * |x | y|
BUCKET_KEYS = 1_500_000
POSTED = 400_000  # keys that a task holds before it hands them on
SKETCH_WORDS = (2, 8, 32, 128)  # sketch sizes in 64-bit words, for up to 64, 256, 1024 and more shingles
BLOCK = 1024


def most(n: np.ndarray | int):
    """Largest size of a set similar to one of size n."""
    return n * UNION // SHARED


def band_edges(limit: int) -> np.ndarray:
    """Largest sizes of the bands 0, 1, ... up to `limit`."""
    out, low = [], 1
    while not out or out[-1] < limit:
        out.append(max(low, most(low)))
        low = out[-1] + 1
    return np.array(out)


@cache
def plans(high: int) -> tuple[tuple[bool, int], ...]:
    """Plans (one-deletion?, segments) for sets of up to `high` shingles, cheapest first, ever finer, at last a segment for each shingle (0).

    Cost of a plan: keys, and 40 for every key expected to be shared by chance, a quarter of shingles being common. Only plans that
    rule out more differences than a pair may have, by expectation, with a margin, are compared.
    """
    bound = 2 * high // 9
    best, cost = (False, 0), float("inf")
    for deletion in (False, True):
        for factor in (0.5, 0.55, 0.6, 0.75, 0.9, 1.05, 1.1, 1.15, 1.25, 1.5, 2.0):
            m = max(1, int(np.ceil(factor * (bound + 1))))
            s = high / m
            empty, one = np.exp(-s), s * np.exp(-s)
            if m == 1:
                empty, one = 0.0, float(high == 1)
            units = m * (2 * (1 - empty - one) + one if deletion else 1 - empty)
            if units < (bound + 1) * (1.03 if m > 1 else 1):
                continue
            chance = m * 0.25**s + (high * 0.25 ** max(s - 1, 0) if deletion else 0)
            c = m + (high if deletion else 0) + 40 * chance
            if c < cost:
                best, cost = (deletion, m), c
    last = max(best[1], bound + 1)
    return (best, (False, last * 3 // 2 + 2), (False, 3 * last + 2), (False, 0))


def segment_keys(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets (packed tokens, set sizes) and the set of each key."""
    edges = band_edges(int(most(int(sizes.max()))) if len(sizes) else 1)
    begin = np.cumsum(sizes) - sizes
    low = np.searchsorted(edges, sizes)
    number = np.searchsorted(edges, most(sizes)) - low + 1
    number[sizes == 0] = 0
    who = np.repeat(np.arange(len(sizes)), number)
    band = np.repeat(low, number) + np.arange(len(who)) - np.repeat(np.cumsum(number) - number, number)
    bound = (sizes[who] + np.minimum(edges[band], most(sizes[who]))) // 9
    deletion = np.array([[p[0] for p in plans(int(h))] for h in edges])
    segments = np.array([[p[1] for p in plans(int(h))] for h in edges], np.int64)
    out, owner = [], []
    for level in range(4):
        if not len(who):
            break
        n = sizes[who]
        t = tokens[ragged(begin[who], n)]
        inst = np.repeat(np.arange(len(who)), n)
        m = segments[band, level]
        seed = mix((band.astype(U64) << U64(8)) + U64(level + 1))
        spread = mix(t ^ seed[inst])
        seg = ((spread >> U64(34)) * m[inst].astype(U64) >> U64(30)).astype(np.int64)
        fine = m[inst] == 0
        seg[fine] = (spread[fine] >> U64(34)).astype(np.int64)
        order = np.argsort(inst << 30 | seg, kind="stable") if not fine.all() else np.lexsort((spread, inst))
        place = (inst << 30 | seg)[order]
        head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        count = np.diff(np.append(head, len(place)))
        value = mix(spread[order] + U64(0x5851F42D4C957F2D))
        total = np.add.reduceat(value, head) if len(head) else value
        whose = inst[order][head]
        tag = mix(seed[whose] ^ (seg[order][head].astype(U64) << U64(8)))
        out.append(mix(total + tag))
        owner.append(who[whose])
        cut = deletion[band, level]
        units = np.bincount(whose, np.where(cut[whose], np.minimum(count, 2), 1), len(who))
        some = cut[whose] & (count > 1)
        if some.any():
            k = np.repeat(np.flatnonzero(some), count[some])
            at = ragged(head[some], count[some])
            out.append(mix(total[k] - value[at] + tag[k]))
            owner.append(who[whose[k]])
        short = units < bound + 1
        if level < 3:
            who, band, bound = who[short], band[short], bound[short]
    return (np.concatenate(out), np.concatenate(owner)) if out else (np.zeros(0, U64), np.zeros(0, np.int64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, packed, and the set sizes."""
    h, _, _, counts = word_hashes(data, offsets)
    s, number = shingle_hashes(h, counts, WIDTH)
    owner = np.repeat(np.arange(len(counts)), number)
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    return s[new], np.bincount(owner[new], minlength=len(counts))


class Names:
    """64-bit names of sets by content. Names that different sets were found to share also take in a second hash, so sets are told apart by 128 bits."""

    def __init__(self, shared: list[int] = (), bits: int = 64):
        self.shared, self.bits = np.array(sorted(shared), np.int64), U64(64 - bits)

    def hashes(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of every set, the first of `bits` bits."""
        end = np.cumsum(sizes)
        both = []
        for salt in (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93):
            total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(tokens ^ U64(salt)))])
            both.append(mix((total[end] - total[end - sizes]) ^ sizes.astype(U64)))
        return (both[0] >> self.bits).view(np.int64), both[1].view(np.int64)

    def of(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name and second hash of every set."""
        first, second = self.hashes(tokens, sizes)
        if len(self.shared):
            again = np.isin(first, self.shared)
            first[again] = mix(first[again].view(U64) ^ mix(second[again].view(U64) + U64(1))).view(np.int64)
        return first, second


def _identify(names: Names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                t, sizes = shingle_sets(*packed(part.column(1)))
                to = np.concatenate([[0], np.cumsum(sizes)])
                name, second = names.of(t, sizes)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), pa.array(name), pa.array(second), pa.array([sketch(t[a:b]) for a, b in zip(to[:-1], to[1:], strict=True)], pa.binary())], names=["_doc", "_n", "_set", "_second", "_sketch"])

    return run


def _post(buckets: int, names_of: Names):
    """Keys of some documents at a time, sorted, as one binary row a bucket: 4 bytes of the key and 8 of the set's name."""

    def rows(keys: list[np.ndarray], names: list[np.ndarray]) -> pa.RecordBatch:
        k, name = np.concatenate(keys), np.concatenate(names)
        bucket = ((k >> U64(34)) * U64(buckets) >> U64(30)).astype(np.int64)
        order = np.lexsort((name, k & U64(0xFFFFFFFF), bucket))
        k, name, bucket = (k & U64(0xFFFFFFFF)).astype("<u4")[order], name[order], bucket[order]
        head = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        to = np.append(head[1:], len(bucket))[: len(head)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[head], pa.int32()), pa.array([k[a:b].tobytes() for a, b in zip(head, to, strict=True)], pa.binary()), pa.array([name[a:b].tobytes() for a, b in zip(head, to, strict=True)], pa.binary())], names=["_bucket", "_keys", "_names"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names, size = [], [], 0
        for batch in batches:
            for part in slices(batch, "_text"):
                t, sizes = shingle_sets(*packed(part.column(0)))
                ids, _ = names_of.of(t, sizes)
                _, once = np.unique(ids, return_index=True)
                once = np.sort(once[sizes[once] > 0])
                begin = np.cumsum(sizes) - sizes
                k, owner = segment_keys(t[ragged(begin[once], sizes[once])], sizes[once])
                keys.append(k)
                names.append(ids[once][owner])
                size += len(k)
                if size >= POSTED:
                    yield rows(keys, names)
                    keys, names, size = [], [], 0
        if size:
            yield rows(keys, names)

    return run


def _match(group: pa.Table) -> pa.Table:
    """Lists of one bucket: candidate pairs (kind 0: first of the list and neighbours), and all members of lists of three or more (kind 1)."""
    k = np.frombuffer(b"".join(x.as_py() for x in group.column("_keys")), "<u4")
    name = np.frombuffer(b"".join(x.as_py() for x in group.column("_names")), "<i8")
    order = np.lexsort((name, k))
    k, name = k[order], name[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (name[1:] != name[:-1])
    k, name = k[new], name[new]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    first = np.maximum.accumulate(np.where(head, np.arange(len(k)), 0))
    size = np.bincount(np.cumsum(head) - 1) if len(k) else np.zeros(0, np.int64)
    rest = np.flatnonzero(~head)
    pairs = np.unique(np.concatenate([np.stack([name[first[rest]], name[rest]], 1), np.stack([name[rest - 1], name[rest]], 1)]), axis=0) if len(rest) else np.zeros((0, 2), np.int64)
    long = np.repeat(size, size) >= 3
    bucket = group.column("_bucket")[0].as_py()
    a = np.concatenate([pairs[:, 0], k[long].astype(np.int64) << 24 | (bucket & 0xFFFFFF)])
    b = np.concatenate([pairs[:, 1], name[long]])
    return pa.table({"_kind": pa.array(np.repeat([0, 1], [len(pairs), int(long.sum())]), pa.int32()), "a": pa.array(a), "b": pa.array(b)})


def _contents(cells, names: Names):
    """Shingles of the sets of the documents that are wanted; the texts of others are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_slots(cells.value, batch.column(2).to_numpy())))
            for part in slices(batch, "_text"):
                t, sizes = shingle_sets(*packed(part.column(1)))
                ids, _ = names.of(t, sizes)
                to = np.concatenate([[0], np.cumsum(sizes)])
                pick = np.flatnonzero(sizes > 0)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(pick)), pa.array(ids[pick]), pa.array([t[to[i] : to[i + 1]].tobytes() for i in pick], pa.binary())], names=["_rep", "_set", "_tokens"])

    return run


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact test on two sorted sets."""
    small, large = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return UNION * both >= SHARED * (len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [similar(np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])


def verified(pairs: DataFrame, content) -> DataFrame:
    """The pairs (a, b) of set names whose sets are similar. A set in many pairs meets them in a join that adaptive execution splits."""
    sets = content(pairs)
    right = pairs.select("a", "b").hint("merge").join(sets.select(F.col("_set").alias("b"), F.col("_tokens").alias("_y")), "b")
    both = right.hint("merge").join(sets.select(F.col("_set").alias("a"), F.col("_tokens").alias("_x")), "a")
    return both.select("a", "b", "_x", "_y").mapInArrow(_verify, "a long, b long")


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that sizes and sketches do not rule out."""
    for batch in batches:
        n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        ok = UNION * np.minimum(n, m) >= SHARED * np.maximum(n, m)
        for i in np.flatnonzero(ok):
            x, y = batch.column(4)[i].as_py(), batch.column(5)[i].as_py()
            words = min(len(x), len(y)) // 8
            ok[i] = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(dtype=np.int64)) <= (n[i] + m[i]) // 9
        yield batch.filter(pa.array(ok)).select(["a", "b"])


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of some slots; its length depends on the set's size."""
    words = SKETCH_WORDS[int(np.searchsorted([64, 256, 1024], len(tokens)))]
    bits = np.bincount((mix(tokens) & U64(64 * SKETCH_WORDS[-1] - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS[-1]) & 1
    return np.packbits(bits.reshape(-1, 64 * words).sum(0) & 1).tobytes()


def folded(raw: bytes, words: int) -> np.ndarray:
    """A sketch folded to fewer words."""
    return np.bitwise_xor.reduce(np.frombuffer(raw, U64).reshape(-1, words), 0)


def _across(group: pa.Table) -> pa.Table:
    """Pairs of different components in one block of a list, or between two blocks, that the sketches do not rule out."""
    side, name, part, n = (group.column(c).to_numpy() for c in ("_side", "_set", "_part", "_n"))
    raw = [x.as_py() for x in group.column("_sketch")]
    words = min(len(r) for r in raw) // 8
    s = np.stack([folded(r, words) for r in raw])
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == side.max())
    out = []
    for i in left:
        j = right[(part[right] != part[i]) & ((name[right] > name[i]) if side.max() == 0 else True)]
        j = j[(UNION * np.minimum(n[j], n[i]) >= SHARED * np.maximum(n[j], n[i]))]
        if len(j):
            apart = np.bitwise_count(s[j] ^ s[i]).sum(1, dtype=np.int64)
            out += [(name[i], name[x]) for x in j[apart <= (n[j] + n[i]) // 9]]
    pairs = np.array(out, np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(np.minimum(pairs[:, 0], pairs[:, 1])), "b": pa.array(np.maximum(pairs[:, 0], pairs[:, 1]))})


def near_duplicates(docs: DataFrame, *, name_bits: int = 64) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles (distinct 5-word shingles), component_id (smallest doc_id reachable by links).

    Words are runs of other bytes than white space, A-Z lower-cased; fewer than five words give one shingle, none give the empty
    set, which links with nothing. Rows whose id is null link with nothing and have a null component; rows of one id are one document, so
    the links of all its texts are its own. Sets are named by name_bits of a hash; a second one of 64 bits shows which names are shared,
    about n^2 / 2^65 of n sets, and those sets get names by both.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"))

    def identified(names: Names) -> tuple[DataFrame, DataFrame]:
        rows = written(texts.mapInArrow(_identify(names), "_doc long, _n long, _set long, _second long, _sketch binary"), "sets")
        return rows, written(rows.where("_n > 0 and _doc is not null").groupBy("_set").agg(F.min("_doc").alias("_rep"), F.min("_second").alias("_low"), F.max("_second").alias("_high")), "reps")

    naming = Names(bits=name_bits)
    rows, sets = identified(naming)
    if shared := [r["_set"] for r in sets.where("_low != _high").select("_set").collect()]:
        release(rows, sets)
        naming = Names(shared, name_bits)
        rows, sets = identified(naming)
    sets = sets.select("_set", "_rep")
    sketches = rows.hint("merge").join(sets.select("_set", F.col("_rep").alias("_doc")), ["_set", "_doc"], "left_semi").dropDuplicates(["_set"]).select("_set", "_n", "_sketch")
    sketches = written(sketches, "sketches")
    volume = rows.agg(F.sum("_n")).first()[0] or 0
    buckets = max(partitions(docs), 1 + volume // BUCKET_KEYS)
    sound = texts.where("_doc is not null and _text is not null")
    posted = sound.select("_text").mapInArrow(_post(buckets, naming), "_bucket int, _keys binary, _names binary")
    found = written(posted.repartition(buckets, "_bucket").groupBy("_bucket").applyInArrow(_match, "_kind int, a long, b long"), "lists")
    lists = found.where("_kind = 1").select(F.col("a").alias("_key"), F.col("b").alias("_set"))

    def content(pairs: DataFrame) -> DataFrame:
        names = pairs.select(F.col("a").alias("_set")).union(pairs.select("b")).distinct()
        wanted = written(sets.join(names, "_set", "left_semi"), "wanted")
        cells = repeated_slots(wanted.select(F.xxhash64("_rep").alias("_draw")), "_draw")
        read = sound.select("_doc", "_text", F.xxhash64("_doc").alias("_draw")).mapInArrow(_contents(cells, naming), "_rep long, _set long, _tokens binary")
        out = written(read.hint("merge").join(wanted, ["_set", "_rep"], "left_semi").dropDuplicates(["_set", "_rep"]), "content")
        release(wanted)
        cells.unpersist()
        return out

    def sketched(pairs: DataFrame) -> DataFrame:
        right = pairs.hint("merge").join(sketches.select(F.col("_set").alias("b"), F.col("_n").alias("_m"), F.col("_sketch").alias("_y")), "b")
        both = right.hint("merge").join(sketches.select(F.col("_set").alias("a"), "_n", F.col("_sketch").alias("_x")), "a")
        return both.select("a", "b", "_n", "_m", "_x", "_y").mapInArrow(_close, "a long, b long")

    pairs = written(sketched(found.where("_kind = 0").select("a", "b").distinct()), "pairs")
    # one pair for each set first; of the others only those that join components
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = written(verified(written(first, "first"), content), "links")
    parts = written(connected_components(links), "parts")
    near = lambda c: parts.select(F.col("node").alias(c), F.col("component").alias(f"_part_{c}"))
    rest = pairs.join(near("a"), "a", "left").join(near("b"), "b", "left").where(F.coalesce("_part_a", "a") != F.coalesce("_part_b", "b")).select("a", "b")
    links = written(links.union(verified(written(rest, "rest"), content)), "links")
    parts = written(connected_components(links), "parts")
    # lists that still fall into several components
    member = lists.join(parts.withColumnRenamed("node", "_set"), "_set", "left").select("_key", "_set", F.coalesce("component", "_set").alias("_part"))
    open_lists = member.groupBy("_key").agg(F.min("_part").alias("_low"), F.max("_part").alias("_high"), F.count("*").alias("_size")).where("_low != _high")
    member = written(member.join(open_lists, "_key").select("_key", "_set", "_part", "_size"), "members")
    # lists with the same members need one comparison
    same = member.groupBy("_key").agg(F.sum(F.xxhash64("_set").cast("decimal(38,0)")).alias("_sum"), F.max("_size").alias("_size"))
    one = same.groupBy("_sum", "_size").agg(F.min("_key").alias("_key")).select("_key")
    member = member.join(one, "_key", "left_semi")
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("_set"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other")
    dealt = member.select("*", block.alias("_own"), other).select("_key", "_set", "_part", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), F.when(F.col("_own") == F.least("_own", "_other"), 0).otherwise(1).alias("_side"))
    more = dealt.join(sketches, "_set").groupBy("_key", "_i", "_j").applyInArrow(_across, "a long, b long").distinct()
    extra = written(verified(written(more, "more"), content), "links")
    # the sets of one id belong together
    several = rows.where("_n > 0 and _doc is not null").groupBy("_doc").agg(F.min("_set").alias("a"), F.max("_set").alias("_last")).where("a != _last").select("_doc", "a")
    own = rows.join(several, "_doc").where("_n > 0 and _set != a").select("a", F.col("_set").alias("b"))
    parts2 = connected_components(links.union(extra).union(own))
    named = parts2.join(sets.withColumnRenamed("_set", "node"), "node")
    smallest = named.groupBy("component").agg(F.min("_rep").alias("_least"))
    final = named.join(smallest, "component").select(F.col("node").alias("_set"), "_least")
    whole = sets.join(final, "_set", "left").select("_set", F.coalesce("_least", "_rep").alias("_least"))
    return rows.join(whole, "_set", "left").select(F.col("_doc").alias("doc_id"), F.col("_n").alias("n_shingles"), F.when(F.col("_doc").isNotNull(), F.when(F.col("_n") > 0, F.col("_least")).otherwise(F.col("_doc"))).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the documents whose component has a smaller doc_id; rows without links or id stay."""
    name = free_name(docs, "_gone")
    gone = near_duplicates(docs).where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")
