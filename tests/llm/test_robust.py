"""Names that clash, numbers that overflow, texts that are long, and stages of the pipeline on odd tables."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cytoframe.llm import chunks, decontam, embeddings, langid, linededup, setjoin, toxicity
from cytoframe.llm.shared import table

SMALL = "/root/testdata/sf0.001"
CLASH = ["_lines", "_gone_doc", "_n_removed", "_n_lines", "_text", "_lang_pred", "_lang_score", "_gone", "_leak", "_doc", "_TEXT2", "_h", "_label"]


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with a column of every name that operators use inside."""
    line = "one two three four five six seven eight"
    rows = [(1, line, "en", "a", 1), (2, line, "en", "a", 2), (None, line, "en", "b", 3), (3, None, None, None, None), (4, "", "de", None, 0), (5, "uno dos tres\n" + line, "es", "c", 9), (5, "uno dos tres\n" + line, "es", "c", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def test_lines_beside_clashing_names(odd):
    kept = linededup.dedup_lines(odd, short=True, n_lines="a", n_removed="b")
    assert kept.columns == [*odd.columns, "a", "b"] and kept.count() == odd.count()
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(1, "one two three four five six seven eight"), (2, ""), (None, "one two three four five six seven eight"), (3, None), (4, ""), (5, "uno dos tres")}


def test_models_beside_clashing_names(spark, odd):
    net = langid.train(odd)
    out = langid.predict(odd, net, keep=tuple(odd.columns), label="l", score="s")
    assert out.columns == [*odd.columns, "l", "s"] and out.count() == odd.count()
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 0), (2, 1)], "doc_id long, toxic int").withColumn("_id", F.lit(1))
    field = toxicity.train(odd, labels)
    assert toxicity.score(odd, field, keep=tuple(odd.columns)).count() == odd.count()


def test_pipeline_on_odd_tables(spark, odd):
    """Every stage takes nulls, repeated ids, clashing names and no rows at all."""
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "bpe" or out.columns == docs.columns
            assert out.count() <= docs.count()
    plain = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, plain, SMALL)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 5, 5]
    near = corpus_pipeline.keep_one_of_near_copies(spark, odd, SMALL)
    assert sorted((r.doc_id or 0) for r in near.collect()) == [0, 1, 3, 4, 5, 5]


def test_pipeline_stages_do_what_they_say(spark):
    """Stage 2 keeps every row; stage 3 keeps the least of each component; stage 4 drops what overlaps() names."""
    docs = table(spark, SMALL, "documents")
    assert corpus_pipeline.drop_repeated_lines(spark, docs, SMALL).count() == docs.count()
    parts = {r.doc_id: r.component_id for r in setjoin.near_duplicates(docs).collect()}
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, SMALL).collect()}
    assert kept == {d for d, c in parts.items() if d == c}
    leaks = {r.doc_id for r in decontam.overlaps(docs, table(spark, SMALL, "benchmark"), short=True).collect()}
    clean = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, docs, SMALL).collect()}
    assert leaks and clean == set(parts) - leaks


@pytest.mark.parametrize("scale", [1e-320, 1e-200, 1e307])
def test_vectors_of_any_size(spark, scale):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [scale, scale * 1.01]), (4, [scale * 2 if scale < 1e300 else scale, scale * 2 if scale < 1e300 else scale]), (5, [-1.0, 1.0]), (6, [0.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6)}


def test_blocks_of_tiles(spark, monkeypatch):
    """Tiny tiles and blocks compare the same pairs as brute force."""
    monkeypatch.setattr(embeddings, "TILE", 5)
    g = np.random.default_rng(5)
    centres = g.normal(0, 1, (12, 6))
    x = np.concatenate([c + g.normal(0, 0.3, (20, 6)) for c in centres])
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9).sum(1) - 1
    assert got == {i: int(k) for i, k in enumerate(near)}


def test_long_texts_are_rebuilt_in_one_walk(spark):
    text = "\n".join(f"word{i} and more words in line {i} of this text" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "x" * 3_000_000), (4, " ".join(f"w{i}" for i in range(300_000)))], "doc_id long, text string")
    at = time.time()
    kept = {r.doc_id: (r._n_lines, r._n_removed) for r in linededup.dedup_lines(docs).drop("text").collect()}
    assert kept == {1: (60_000, 0), 2: (60_000, 60_000), 3: (1, 0), 4: (1, 0)}
    assert time.time() - at < 120


def test_kept_text_matches_its_digest(spark):
    """Chunks never cut a character, so the text that stays is the bytes that stay."""
    import hashlib

    body = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(2000))
    docs = spark.createDataFrame([(1, body), (2, "é" * 7 + body[300:1500] + "ü" * 9), (3, body[::-1])], "doc_id long, text string")
    for r in chunks.dedup_chunks(docs).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert len(r.kept.encode()) == r.n_bytes - r.n_removed


def test_every_allowed_substitution_is_found(spark):
    """Items of 1 to 13 words, with every set of places that may differ replaced in a document."""
    from itertools import combinations
    from math import ceil

    items, docs, want = [], [], set()
    for n in range(1, 14):
        words = [f"word{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        for t in range(n - ceil(0.8 * n - 1e-9) + 1):
            for bad in combinations(range(n), t):
                want.add((len(docs), n))
                docs.append((len(docs), " ".join(["before", *(f"other{i}" if i in bad else w for i, w in enumerate(words)), "after"])))
    found = decontam.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), short=True)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want
