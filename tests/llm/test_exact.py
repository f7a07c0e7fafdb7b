"""Words built so that polynomial hashes modulo 2**64 collide still count as different."""

import hashlib

import numpy as np
import pytest

from cytoframe.llm import bpe, linededup, queries, setjoin, tokenfile
from cytoframe.llm.hashing import BYTE, span_hashes


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_span_hashes(n):
    x, y = (thue_morse(n, *ab).encode() for ab in ("ab", "ba"))
    data = np.frombuffer(x + y + x, np.uint8)
    h = span_hashes(BYTE[data], np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n]))
    assert h[0] == h[2] != h[1]


def test_tokens_of_colliding_words(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    texts = {k: " ".join(["", thue_morse(n, "a", "b"), thue_morse(n, "b", "a"), "tail", thue_morse(n, "a", "b")]) for k, n in enumerate((1024, 2048, 8192))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    ids = {k: t.encode(v, add_special_tokens=False).ids for k, v in texts.items()}
    got = {r.doc_id: r.ids_sha256 for r in bpe.encode_decode(docs, queries.TOKENIZER).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in ids.items()}
    path = f"{spark.conf.get('spark.checkpoint.dir', '/tmp/cytoframe-shared')}/exact-{hash(spark)}"
    tokenfile.write_token_file(docs, path, queries.TOKENIZER)
    blocks = spark.read.parquet(path).collect()
    read = {d: tokenfile.document_ids(b.asDict(), i).tolist() for b in blocks for i, d in enumerate(b.doc_ids)}
    assert read == {k: [*v, 0] for k, v in ids.items()}


def test_words_of_one_hash_keep_their_ids():
    """Forced collisions inside a slice and with the table."""
    m = bpe.Merges(queries.TOKENIZER)
    texts = ["apple pear apple", "plum pear fig apple", "x" * 300 + " " + "x" * 301]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    want = m.encode(data, offsets)
    real = bpe.word_lanes
    try:
        bpe.word_lanes = lambda *a: (*real(*a)[:2], np.full(len(a[1]), 5, np.uint64))
        n = bpe.Merges(queries.TOKENIZER)
        for _ in range(3):
            got = n.encode(data, offsets)
            assert all((a == b).all() for a, b in zip(got, want, strict=True))
    finally:
        bpe.word_lanes = real


def test_lines_and_sets_of_colliding_words(spark):
    a, b = thue_morse(1024, "u ", "v "), thue_morse(1024, "v ", "u ")
    p, q = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    docs = spark.createDataFrame([(1, a), (2, b), (3, a), (4, p), (5, q), (6, p)], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert kept == {1: a, 2: b, 3: "", 4: p, 5: q, 6: ""}
    assert {r.doc_id: r.component_id for r in setjoin.near_duplicates(docs.where("doc_id > 3")).collect()} == {4: 4, 5: 5, 6: 4}
