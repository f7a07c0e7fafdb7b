"""Toxic spans by a linear-chain conditional random field over words, and document scores from its marginals."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.hashing import LOWER, U64, mix, word_hashes
from cytoframe.llm.shared import free_name, packed, slices

#: Bounded fit: about so many labelled documents of either label for word counts and scores, and so many for the chain; whole texts.
DOCS_A_LABEL, CHAIN_DOCS = 5_000, 400
BUCKETS = 1 << 20
KINDS = 3  # the word, its first four bytes, its first five
LEAST_DOCS, LEAST_ODDS, TOXIC_ODDS, MOST_ODDS = 3, 1.5, 3.0, 8.0
PIECE = 128  # tokens of a text that the fit of the chain takes as one sequence; a text gives as many as it holds
BLOCK = 64


def token_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets (tokens, KINDS), starts and ends of the tokens, and tokens of each text."""
    h, starts, ends, counts = word_hashes(data, offsets, letters=True)
    low = np.concatenate([LOWER[data], np.zeros(5, np.uint8)]).astype(U64)
    kinds = [h]
    for width in (4, 5):
        p = np.full(len(starts), width, U64)
        for i in range(width):
            p = p << U64(8) | np.where(starts + i < ends, low[starts + i], U64(0))
        kinds.append(p)
    return np.stack([(mix(k + U64(i)) & U64(BUCKETS - 1)).astype(np.int64) + i * BUCKETS for i, k in enumerate(kinds)], 1), starts, ends, counts


def _mobius(m: list[np.ndarray], start: float) -> np.ndarray:
    """x[t] = (a x[t-1] + b) / (c x[t-1] + d) for all t: products inside blocks, then from block to block, then inside again."""
    n = len(m[0])
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    a, b, c, d = (np.concatenate([v, np.full(pad, e)]).reshape(blocks, BLOCK) for v, e in zip(m, (1.0, 0.0, 0.0, 1.0), strict=True))
    p, q, r, s = (v[:, 0].copy() for v in (a, b, c, d))
    for t in range(1, BLOCK):
        p, q, r, s = a[:, t] * p + b[:, t] * r, a[:, t] * q + b[:, t] * s, c[:, t] * p + d[:, t] * r, c[:, t] * q + d[:, t] * s
        top = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / top, q / top, r / top, s / top
    enter = np.empty(blocks)
    x = start
    for i, (w, y, z, v) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        enter[i] = x
        x = min((w * x + y) / (z * x + v), 1e150)
    out = np.empty((blocks, BLOCK))
    x = enter
    for t in range(BLOCK):
        x = np.minimum((a[:, t] * x + b[:, t]) / (c[:, t] * x + d[:, t]), 1e150)
        out[:, t] = x
    return out.reshape(-1)[:n]


@dataclass
class Field:
    """Two states (clean, toxic): weights of the evidence, and log-potentials of the four transitions."""

    odds: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    score: np.ndarray

    def evidence(self, buckets: np.ndarray) -> np.ndarray:
        return self.odds[buckets]

    def marginals(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """P(toxic) of every token by forward-backward over the chain of its text."""
        n = len(x)
        if not n:
            return np.zeros(0)
        phi = np.exp(np.minimum(x @ self.weights[:-1] + self.weights[-1], 60.0))
        a = np.exp(self.moves)
        first, last = np.zeros(n, bool), np.zeros(n, bool)
        ends = np.cumsum(counts)[counts > 0]
        last[ends - 1] = True
        first[0] = True
        first[ends[:-1]] = True
        one = np.ones(n)
        r = _mobius([np.where(first, 0, a[1, 1] * phi), np.where(first, phi, a[0, 1] * phi), np.where(first, 0, a[1, 0]), np.where(first, 1, a[0, 0])], 1.0)
        ahead = np.append(phi[1:], 1.0)
        back = [np.where(last, 0, a[1, 1] * ahead), np.where(last, 1, a[1, 0] * one), np.where(last, 0, a[0, 1] * ahead), np.where(last, 1, a[0, 0] * one)]
        s = _mobius([v[::-1] for v in back], 1.0)[::-1]
        odds = r * s
        return odds / (1 + odds)

    def document_features(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Per text: log-odds of its most toxic token, and log of the number of tokens above one half."""
        owner = np.repeat(np.arange(len(counts)), counts)
        top = np.zeros(len(counts))
        np.maximum.at(top, owner, p)
        many = np.bincount(owner, p >= 0.5, len(counts))
        top = np.clip(top, 1e-6, 1 - 1e-6)
        return np.stack([np.log(top / (1 - top)), np.log1p(many), np.ones(len(counts))], 1)

    def document_scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.score)))


def fit_chain(x: np.ndarray, y: np.ndarray, real: np.ndarray, rounds: int = 80, rate: float = 0.15) -> tuple[np.ndarray, np.ndarray]:
    """Likelihood ascent (Adam, small L2) over padded sequences x (documents, tokens, evidence), labels y, mask real.

    Without a token the weights stay as they start.
    """
    d, n, k = x.shape
    theta = np.concatenate([np.full(k, 0.3), [-3.0], [0.0, -1.0, 0.0, 0.0]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    want = np.zeros_like(theta)
    want[:k] = np.einsum("dnk,dn->k", x, y * real)
    want[k] = (y * real).sum()
    pairs = real[:, 1:] * 1.0
    for i, (s, t) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        want[k + 1 + i] = (pairs * (y[:, :-1] == s) * (y[:, 1:] == t)).sum()
    total = real.sum()
    for step in range(1, rounds + 1 if total else 1):
        phi = np.exp(np.clip(x @ theta[:k] + theta[k], -60, 60))
        a = np.exp(theta[k + 1 :]).reshape(2, 2)
        e = np.stack([np.ones_like(phi), phi], 2)
        alpha, beta = np.empty((d, n, 2)), np.ones((d, n, 2))
        alpha[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, n):
            z = (alpha[:, t - 1] @ a) * e[:, t]
            alpha[:, t] = np.where(real[:, t, None], z / z.sum(1, keepdims=True), alpha[:, t - 1])
        for t in range(n - 2, -1, -1):
            z = (e[:, t + 1] * beta[:, t + 1]) @ a.T
            beta[:, t] = np.where(real[:, t + 1, None], z / z.sum(1, keepdims=True), 1.0)
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        xi = alpha[:, :-1, :, None] * a[None, None] * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
        xi /= xi.sum((2, 3), keepdims=True)
        got = np.concatenate([np.einsum("dnk,dn->k", x, p[:, :, 1] * real), [(p[:, :, 1] * real).sum()], (xi * pairs[:, :, None, None]).sum((0, 1)).reshape(-1)])
        g = (want - got) / total - 1e-4 * theta
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return theta[: k + 1], theta[k + 1 :].reshape(2, 2)


def fit_score(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small L2, both labels weighing as they occur."""
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.1 * np.eye(len(w))
        w = w + np.linalg.solve(h, z.T @ (y - p) - 0.1 * w)
    return w


def train(docs: DataFrame, labels: DataFrame, *, text_column: str = "text", label_column: str = "toxic") -> Field | None:
    """Fits the field on a bounded sample of the labelled documents, about DOCS_A_LABEL of either label (the chain on CHAIN_DOCS of them).

    Which documents are sampled depends on a hash of their id only; their number is what is broadcast. Whole texts are used. Extra columns
    of either table may have any name. Word labels come from the
    document labels: a word of a toxic document is toxic if its evidence, the log-odds of its features between the two kinds of
    documents less one standard error, is at least TOXIC_ODDS. None if no sampled document of either label has a word: if a label is missing, or its ids
    are not in docs, or its texts are null, empty or without letters and digits.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label_column).alias("_label")).where("_id is not null and _label in (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label"))
    counts = {r["_label"]: r["count"] for r in known.groupBy("_label").count().collect()}
    if len(counts) < 2:
        return None
    share = lambda n: F.when(F.col("_label") == 1, min(1.0, n / counts[1])).otherwise(min(1.0, n / counts[0]))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(draw < share(DOCS_A_LABEL)).withColumn("_chain", draw < share(CHAIN_DOCS))
    sample = docs.select(F.col("doc_id").alias("_id"), F.col(text_column).alias("_text")).where("_text is not null").join(F.broadcast(picked), "_id").select("_text", "_label", "_chain")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, KINDS * BUCKETS), np.int32)
        number, worded = np.zeros(2, np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for part in slices(batch, "_text"):
                buckets, _, _, counts = token_buckets(*packed(part.column(0)))
                owner = np.repeat(np.arange(part.num_rows), counts)
                y = part.column(1).to_numpy(zero_copy_only=False)
                pair = np.unique((owner[:, None] * (KINDS * BUCKETS) + buckets).reshape(-1))
                for k in (0, 1):
                    number[k] += (y == k).sum()
                    worded[k] += ((y == k) & (counts > 0)).sum()
                    np.add.at(tables[k], pair[y[pair // (KINDS * BUCKETS)] == k] % (KINDS * BUCKETS), 1)
        at = np.flatnonzero(tables.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.concatenate([tables[0, at], [number[0], worded[0]]])), pa.array(np.concatenate([tables[1, at], [number[1], worded[1]]]))], names=["_bucket", "_clean", "_toxic"])

    stats = sample.mapInArrow(count, "_bucket long, _clean long, _toxic long").groupBy("_bucket").agg(F.sum("_clean").alias("_clean"), F.sum("_toxic").alias("_toxic")).where(f"_bucket < 0 or _toxic >= {LEAST_DOCS}").toPandas()
    if not (stats.loc[stats["_bucket"] == -2, ["_clean", "_toxic"]] > 0).all(None) or not len(stats):
        return None
    total = stats[stats["_bucket"] == -1].iloc[0]
    stats = stats[stats["_bucket"] >= 0]
    odds = np.zeros(KINDS * BUCKETS, np.float32)
    value = np.log((stats["_toxic"] + 0.5) / (total["_toxic"] + 1.0)) - np.log((stats["_clean"] + 0.5) / (total["_clean"] + 1.0))
    value -= np.sqrt(1 / (stats["_toxic"] + 0.5) + 1 / (stats["_clean"] + 0.5))  # one standard error: few documents are weak evidence
    odds[stats["_bucket"].to_numpy()] = np.where(value >= LEAST_ODDS, np.minimum(value, MOST_ODDS), 0)
    shared = spark.sparkContext.broadcast(odds)

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                buckets, _, _, counts = token_buckets(*packed(part.column(0)))
                x = shared.value[buckets]
                to = np.concatenate([[0], np.cumsum(counts)])
                cuts = [(i, a, min(a + PIECE, int(to[i + 1]))) for i in range(part.num_rows) for a in range(int(to[i]), int(to[i + 1]), PIECE)]
                owner = pa.array([c[0] for c in cuts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(1).take(owner), pa.array([np.ascontiguousarray(x[a:b]).tobytes() for _, a, b in cuts], pa.binary())], names=["_label", "_x"])

    got = sorted(((int(r["_label"]), bytes(r["_x"])) for r in sample.where("_chain").mapInArrow(sequences, "_label int, _x binary").collect()), key=lambda r: (r[1], r[0]))
    x, y, real = np.zeros((len(got), PIECE, KINDS)), np.zeros((len(got), PIECE)), np.zeros((len(got), PIECE), bool)
    for i, (label, raw) in enumerate(got):
        own = np.frombuffer(raw, np.float32).reshape(-1, KINDS)
        x[i, : len(own)], real[i, : len(own)] = own, True
        y[i, : len(own)] = label * (own.max(1) >= TOXIC_ODDS) if len(own) else 0
    weights, moves = fit_chain(x, y, real)
    field = Field(odds, weights, moves, np.zeros(3))
    chain = spark.sparkContext.broadcast(field)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                buckets, _, _, counts = token_buckets(*packed(part.column(0)))
                z = chain.value.document_features(chain.value.marginals(chain.value.evidence(buckets), counts), counts)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(z[:, 0]), pa.array(z[:, 1])], names=["_label", "_a", "_b"])

    z = sample.mapInArrow(features, "_label int, _a double, _b double").toPandas().sort_values(["_a", "_b", "_label"])
    field.score = fit_score(np.stack([z["_a"], z["_b"], np.ones(len(z))], 1), z["_label"].to_numpy(float))
    return field


def score(docs: DataFrame, field: Field | None, *, text_column: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` of every row with score, predicted, n_toxic_words and spans (character offsets of runs of toxic words).

    Every word of a whole text is tagged. Null and empty texts have no word and get the score of a text without evidence; without a
    fitted field every score is 0. Repeated rows repeat; an empty table gives an empty one.
    """
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    if field is None:
        return docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).cast("long").alias("n_toxic_words"), F.array().cast(spans).alias("spans"))
    fields = [docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("n_toxic_words", T.LongType()), T.StructField("spans", spans)]
    shared = docs.sparkSession.sparkContext.broadcast(field)
    name = free_name(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            for part in slices(batch, name):
                data, offsets = packed(part.column(0))
                buckets, starts, ends, counts = token_buckets(data, offsets)
                p = f.marginals(f.evidence(buckets), counts)
                s = f.document_scores(f.document_features(p, counts))
                owner = np.repeat(np.arange(part.num_rows), counts)
                hit = np.flatnonzero(p >= 0.5)
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                head = np.ones(len(hit), bool)
                head[1:] = (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])
                begin, stop = hit[head], hit[np.append(np.flatnonzero(head)[1:] - 1, len(hit) - 1)] if len(hit) else hit[:0]
                origin = chars[offsets[:-1]][owner[begin]]
                number = np.bincount(owner[begin], minlength=part.num_rows)
                runs = pa.StructArray.from_arrays([pa.array(chars[starts[begin]] - origin), pa.array(chars[ends[stop]] - origin)], names=["start", "end"])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)]), pa.int32()), runs)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(np.bincount(owner[hit], minlength=part.num_rows)), lists], names=[x.name for x in fields])

    return docs.select(F.col(text_column).alias(name), *keep).mapInArrow(run, T.StructType(fields))
