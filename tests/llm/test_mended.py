"""Cases that once gave wrong rows: runs of one byte under a hot anchor, labels without texts, odd letters, set names, ids of several texts."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from cytoframe.llm import bpe, runindex, setjoin, toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def covered(texts):
    """Bytes of each text that a 200-byte string covers which starts elsewhere too."""
    raw = [t.encode() for t in texts]
    times = Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    out = []
    for x in raw:
        gone = np.zeros(len(x) + 1, int)
        for i in range(len(x) - 199):
            if times[x[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        out.append(int((np.cumsum(gone)[:-1] > 0).sum()))
    return out


def test_runs_of_one_byte_under_a_hot_anchor(spark):
    g = random.Random(2)
    letters = lambda n: "".join(g.choice("abcdefghijklmnop") for _ in range(n))
    texts = []
    for byte, extra in ((" ", 46), ("-", 20)):
        texts += [letters(150) + chr(0x4E00 + i) + byte * (210 + i) + chr(0x4E00 + i) + letters(150) for i in range(extra)]
        texts += [letters(60) + byte * 200 + letters(60) for _ in range(300)]
    texts += [letters(100) + "=" * 200 + letters(50), letters(30) + "=" * 199, "_" * 200, "_" * 201]
    got = {r.doc_id: r.n_removed for r in runindex.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    want = covered(texts)
    assert sum(n > 200 for n in want) > 60
    assert [got[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("texts", [[(1000 + i, "plain words here") for i in range(30)], [(i, None) for i in range(30)], [(i, ["", " \n", "?!"][i % 3]) for i in range(30)], [(i, "word here" if i % 2 else "") for i in range(30)]])
def test_labels_without_words(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(30)], "doc_id long, toxic int")
    field = toxicity.train(docs, labels)
    assert field is None
    assert all(r.score == 0.0 and r.predicted == 0 for r in toxicity.score(docs, field).collect())


def test_labels_without_a_common_word(spark):
    docs = spark.createDataFrame([(i, f"w{i} q{i}") for i in range(40)] + [(99, ""), (98, None)], "doc_id long, text string")
    field = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    rows = toxicity.score(docs, field).collect()
    assert len(rows) == 42 and all(0 <= r.score <= 1 for r in rows)


def test_every_code_point_beside_a_contraction():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(TOKENIZER), bpe.Merges(TOKENIZER)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 8000):
        texts = ["".join(f"{c}'ll1{c}a !{c}" for c in points[j : j + 400]) for j in range(i, min(i + 8000, len(points)), 400)]
        raw = [t.encode() for t in texts]
        ids, counts = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


A, B = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")


def test_sets_of_one_name(spark):
    """With names of 4 bits nearly all sets share one, and results stay."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(60)] + [(100, A), (101, A + " more"), (102, B), (103, B), (104, "one two"), (105, "One two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: i for i in range(60)} | {100: 100, 101: 100, 102: 102, 103: 102, 104: 104, 105: 104}
    assert {r.doc_id: r.component_id for r in setjoin.near_duplicates(docs, name_bits=4).collect()} == want
    assert {r.doc_id: r.component_id for r in setjoin.near_duplicates(docs).collect()} == want


def test_texts_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame([(3, A), (5, A + " more"), (5, B), (7, B + " word"), (8, ""), (8, None), (None, A), (9, "x y z"), (9, "other"), (9, "other")], "doc_id long, text string")
    got = setjoin.near_duplicates(docs).collect()
    assert len(got) == 10
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3), (7, 3), (8, 8), (None, None), (9, 9)}
