"""Language identification by a byte convolutional network, trained here in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cytoframe.llm.shared import free_name, packed, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: Bounded fit: about so many documents of each language, each with its whole text.
DOCS_A_LANGUAGE = 600
EPOCHS, BATCH, RATE = 2, 64, 0.004


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts cut into rows of WINDOW bytes, zero-padded at each text's end, and the text of each row."""
    size = np.diff(offsets)
    number = -(-size // WINDOW)
    owner = np.repeat(np.arange(len(size)), number)
    at = (np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)) * WINDOW
    begin = offsets[:-1][owner] + at
    grid = begin[:, None] + np.arange(WINDOW)
    rows = data[np.minimum(grid, max(len(data) - 1, 0))] if len(data) else np.zeros((0, WINDOW), np.uint8)
    rows[grid >= offsets[1:][owner][:, None]] = 0
    return rows, owner


class ByteNet:
    """Embedding, filters of several widths, ReLU, max over the window, softmax."""

    def __init__(self, classes: list[str], seed: int = 7):
        g = np.random.default_rng(seed)
        self.classes = classes
        self.embed = g.normal(0, 0.3, (256, EMBED)).astype(np.float32)
        self.filters = [g.normal(0, (2 / (w * EMBED)) ** 0.5, (w, EMBED, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = g.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(classes))).astype(np.float32)
        self.out_bias = np.zeros(len(classes), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.out_bias]

    def fit(self, rows: np.ndarray, labels: np.ndarray, seed: int = 11) -> ByteNet:
        """Adam over cross-entropy; each class weighs the same."""
        g = np.random.default_rng(seed)
        weight = len(labels) / (len(self.classes) * np.maximum(np.bincount(labels, minlength=len(self.classes)), 1))
        params = self.weights()
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(EPOCHS):
            order = g.permutation(len(labels))
            for i in range(0, len(order), BATCH):
                pick = order[i : i + BATCH]
                step += 1
                for p, d, m, v in zip(params, self._gradients(rows[pick], labels[pick], weight), first, second, strict=True):
                    m += 0.1 * (d - m)
                    v += 0.001 * (d * d - v)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        n = len(x)
        e = self.embed[x]
        tops, wins = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias, strict=True):
            z = sum(e[:, j : WINDOW - w + 1 + j] @ f[j] for j in range(w)) + b
            best = z.argmax(1)
            wins.append(best)
            tops.append(np.take_along_axis(z, best[:, None], 1)[:, 0])
        h = np.concatenate(tops, 1)
        a = np.maximum(h, 0)
        d = self._softmax(a @ self.out + self.out_bias)
        d[np.arange(n), y] -= 1
        d *= (weight[y] / n)[:, None].astype(np.float32)
        back = (d @ self.out.T) * (h > 0)
        d_embed, d_filters, d_bias = np.zeros_like(self.embed), [], []
        for k, (w, f) in enumerate(zip(WIDTHS, self.filters, strict=True)):
            g = back[:, k * FILTERS : (k + 1) * FILTERS]
            df = np.zeros_like(f)
            for j in range(w):
                byte = np.take_along_axis(x, wins[k] + j, 1)
                df[j] = np.einsum("nfe,nf->ef", self.embed[byte], g)
                np.add.at(d_embed, byte.reshape(-1), (g[:, :, None] * f[j].T[None]).reshape(-1, EMBED))
            d_filters.append(df)
            d_bias.append(g.sum(0))
        return [d_embed, *d_filters, *d_bias, a.T @ d, d.sum(0)]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def tables(self) -> list[tuple[np.ndarray, ...]]:
        """Filter responses of all byte pairs (or single bytes), so that a window is scored by table look-ups."""
        out = []
        for w, f in zip(WIDTHS, self.filters, strict=True):
            one = [self.embed @ f[j] for j in range(w)]
            two = [(one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) for j in range(0, w - 1, 2)]
            out.append((*two, *([one[-1]] if w % 2 else [])))
        return out

    def log_probabilities(self, rows: np.ndarray, tables: list[tuple[np.ndarray, ...]], step: int = 256) -> np.ndarray:
        """Log-probability of each class for each window."""
        out = np.zeros((len(rows), len(self.classes)))
        for i in range(0, len(rows), step):
            x = rows[i : i + step].astype(np.int64)
            pair = x[:, :-1] << 8 | x[:, 1:]
            tops = []
            for w, b, t in zip(WIDTHS, self.bias, tables, strict=True):
                n = WINDOW - w + 1
                z = t[0][pair[:, :n]]
                for j, more in enumerate(t[1:], 1):
                    z += more[(pair if len(more) == 65536 else x)[:, 2 * j : 2 * j + n]]
                tops.append(z.max(1) + b)
            z = np.maximum(np.concatenate(tops, 1), 0) @ self.out + self.out_bias
            z = z - z.max(1, keepdims=True)
            out[i : i + step] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def train(labelled: DataFrame, *, text_column: str = "text", lang_column: str = "lang") -> ByteNet | None:
    """Fits the network on a bounded sample of the labelled rows: about DOCS_A_LANGUAGE documents of each language, whole texts.

    The sample is the rows with the smallest hashes, by a share that each language's count sets, and never more than twice as many rows
    as asked for; texts that repeat under many ids are drawn as often as others. Null labels and texts are left out. Extra columns may
    have any name. None if no row is labelled.
    """
    own = [c for c in labelled.columns if not isinstance(labelled.schema[c].dataType, T.MapType)]
    rows = labelled.select(F.col(text_column).alias("_text"), F.col(lang_column).alias("_lang"), F.xxhash64(*own).alias("_draw")).where("_text is not null and _lang is not null and length(_text) > 0")
    counts = {r["_lang"]: r["count"] for r in rows.groupBy("_lang").count().collect()}
    if not counts:
        return None
    classes = sorted(counts)
    share = F.create_map(*[F.lit(v) for k in classes for v in (k, min(1.0, DOCS_A_LANGUAGE / counts[k]))])
    sample = rows.where((F.pmod("_draw", F.lit(1 << 40)) / F.lit(float(1 << 40))) < share[F.col("_lang")])
    sample = sample.orderBy("_draw", "_lang", "_text").limit(2 * DOCS_A_LANGUAGE * len(classes)).select("_text", "_lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                cut, owner = windows(*packed(part.column(0)))
                raw = cut.tobytes()
                yield pa.RecordBatch.from_arrays([part.column(1).take(pa.array(owner)), pa.array([raw[i : i + WINDOW] for i in range(0, len(raw), WINDOW)], pa.binary())], names=["_lang", "_row"])

    got = sorted((r["_row"], r["_lang"]) for r in sample.mapInArrow(run, "_lang string, _row binary").collect())
    x = np.frombuffer(b"".join(bytes(r) for r, _ in got), np.uint8).reshape(-1, WINDOW)
    y = np.array([classes.index(c) for _, c in got])
    return ByteNet(classes).fit(x, y)


def predict(docs: DataFrame, net: ByteNet | None, *, text_column: str = "text", keep: tuple[str, ...] = (), label: str = "lang_pred", score: str = "score") -> DataFrame:
    """Columns `keep` of every row with the predicted language and its probability.

    All windows of a whole text are scored and their log-probabilities averaged by the bytes they hold. Text that is null or has no letter, and any
    text when nothing was learned, gives `und` with score 0. An empty table gives an empty one; repeated rows repeat; columns that are
    not named in `keep` are ignored, whatever their names.
    """
    if net is None:
        return docs.select(*keep, F.lit("und").alias(label), F.lit(0.0).alias(score))
    fields = [docs.schema[c] for c in keep] + [T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())]
    shared = docs.sparkSession.sparkContext.broadcast(net)
    name = free_name(docs, "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        tables = model.tables()
        ascii_letter = np.zeros(256, bool)
        ascii_letter[[*range(65, 91), *range(97, 123)]] = True
        for batch in batches:
            for part in slices(batch, name):
                data, offsets = packed(part.column(0))
                rows, owner = windows(data, offsets)
                logp = model.log_probabilities(rows, tables)
                filled = (rows != 0).sum(1)
                n = part.num_rows
                total = np.stack([np.bincount(owner, logp[:, k] * filled, n) for k in range(len(model.classes))], 1) if len(owner) else np.zeros((n, len(model.classes)))
                size = np.maximum(np.bincount(owner, filled, n), 1) if len(owner) else np.ones(n)
                p = ByteNet._softmax(total / size[:, None])
                best = p.argmax(1)
                seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
                letter = seen[offsets[1:]] > seen[offsets[:-1]]
                raw = data.tobytes()
                for i in np.flatnonzero(~letter):
                    letter[i] = has_letter(raw[offsets[i] : offsets[i + 1]])
                out = [model.classes[b] if ok else "und" for b, ok in zip(best, letter, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(out, pa.string()), pa.array(np.where(letter, p[np.arange(n), best], 0.0))], names=[f.name for f in fields])

    return docs.select(F.col(text_column).alias(name), *keep).mapInArrow(run, T.StructType(fields))
