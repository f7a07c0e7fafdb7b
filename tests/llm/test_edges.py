"""Nulls, empty tables, repeated rows, clashing columns: every operator gives its defined result."""

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from cytoframe.llm import bpe, chunks, decontam, embeddings, langid, linededup, runindex, setjoin, tokenfile, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_lines(docs):
    got = linededup.dedup_lines(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = by_id(got)
    assert rows[1]._n_removed == 0
    assert rows[2].text == ""  # both lines are one word away from, or equal to, those of document 1
    assert rows[3].text == ""  # one word less
    assert rows[4].text is None and rows[5].text == "" and rows[10].text == "\n\n \t\n"
    assert rows[None]._n_removed == 0 and got.count() == docs.count()
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_bpe_and_token_file(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    odd = docs.select("doc_id", "text").union(spark.createDataFrame([(20, "it's we'll  x\n\n <|endoftext|>'re　é " + "z" * 700), (21, "'s''t 1a ٣ 😀\r\n")], "doc_id long, text string"))
    for r in bpe.encode_decode(odd, TOKENIZER, with_ids=True).join(odd.distinct(), "doc_id").collect():
        want = t.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.decoded == t.decode(want, skip_special_tokens=False)
    path = str(tmp_path / "tokens")
    tokenfile.write_token_file(odd, path, TOKENIZER)
    got = sorted(tokenfile.read_token_file(spark, path).collect(), key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert got[0].doc_id is None and [r.doc_id for r in got[1:]] == sorted(r.doc_id for r in got[1:])
    texts = {r.doc_id: r.text for r in odd.collect()}
    for r in got:
        ids = t.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
    row = spark.read.parquet(path).orderBy(F.desc("n_tokens")).first().asDict()
    ids, at = tokenfile.block_ids(row), 0
    for k, n in enumerate(row["doc_sizes"]):
        assert tokenfile.document_ids(row, k).tolist() == ids[at : at + n].tolist()
        at += n
    assert bpe.encode_decode(docs.limit(0), TOKENIZER).count() == 0


def test_toxicity(spark, docs):
    rows = [(100 + i, f"plain words number w{i} and more plain words" + (" vile scum" if i % 3 == 0 else "")) for i in range(120)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 100 % 3)) for i, _ in rows], "doc_id long, toxic int")
    field = toxicity.train(train, labels)
    got = by_id(toxicity.score(train, field))
    assert all(got[i].predicted == int("scum" in x) for i, x in rows)
    assert [(s.start, s.end) for s in got[100].spans] == [(rows[0][1].index("vile"), len(rows[0][1]))]
    assert toxicity.score(docs, field).count() == docs.count()
    assert toxicity.train(train, labels.limit(0)) is None
    assert toxicity.score(docs, None).where("score != 0").count() == 0


def test_language(docs):
    net = langid.train(docs)
    got = langid.predict(docs, net, keep=("doc_id",))
    rows = by_id(got)
    assert rows[4].lang_pred == rows[5].lang_pred == rows[8].lang_pred == rows[10].lang_pred == "und"
    assert got.count() == docs.count()
    assert langid.predict(docs, langid.train(docs.limit(0)), keep=("doc_id",)).where("lang_pred != 'und'").count() == 0


def test_near_documents(docs):
    got = setjoin.near_duplicates(docs)
    rows = by_id(got)
    assert rows[7].component_id == 6 and rows[6].n_shingles == 2996
    assert rows[4].n_shingles == rows[5].n_shingles == rows[10].n_shingles == 0 and rows[5].component_id == 5
    assert rows[None].component_id is None and got.count() == docs.count()
    assert setjoin.near_duplicates(docs.limit(0)).count() == 0
    assert {r.doc_id for r in setjoin.keep_one(docs).collect()} == {None, 1, 3, 4, 5, 6, 8, 9, 10}  # 1 and 2 share 13 of 15 shingles


def test_substrings(docs):
    got = by_id(runindex.drop_repeats(docs))
    assert got[9].n_removed == 2000 and got[9].n_spans == 1
    assert got[6].n_removed == got[7].n_removed > 0 and got[4].n_bytes == 0 and got[None].n_removed == 0
    some = by_id(chunks.dedup_chunks(docs))
    assert some[6].n_removed == 0 and some[7].copies_of == [6] and some[4].n_bytes == 0
    for f in (runindex.drop_repeats, chunks.dedup_chunks):
        assert f(docs).count() == docs.count() and f(docs.limit(0)).count() == 0


def test_benchmark(spark, docs):
    items = spark.createDataFrame([(1, "W5, w6 w7 w8 w9 xx w11 w12 w13 w14 w15 w16 w17 w18 w19"), (2, None), (3, ""), (4, "w1 w2"), (None, "w5 w6 w7 w8 w9 w10 w11 w12")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, items).collect()}
    assert got == {(6, 1), (7, 1)}
    assert decontam.overlaps(docs, items.limit(0)).count() == decontam.overlaps(docs.limit(0), items).count() == 0


def test_vectors(spark):
    v = [(1, [1.0, 0.0, 0.0]), (2, [2.0, 0.1, 0.0]), (3, [0.0, 1.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0]), (7, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (8, [1.0, None, 0.0]), (9, [1.0])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[7] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 8, 9)) and got[None] == (0, None, False)
    assert embeddings.near_vectors(df.limit(0)).count() == 0
