"""A passage of 64 bytes and more that stands in hundreds of contexts: its anchors are cut again by longer ones."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cytoframe.llm import runindex


@pytest.mark.parametrize("length", [90, 150])
def test_contexts_of_a_common_passage(spark, length, monkeypatch):
    monkeypatch.setattr(runindex, "MANY", 12)
    g = random.Random(length)
    text = lambda n: "".join(g.choice("abcdefghij") for _ in range(n))
    common = text(length)
    halves = [text(120) for _ in range(8)]
    docs = [(i, text(g.randrange(150)) + g.choice(halves)[g.randrange(60) :] + common + g.choice(halves)[: g.randrange(120)] + text(g.randrange(150))) for i in range(120)]
    times = Counter(x[i : i + 200] for _, x in docs for i in range(len(x) - 199))
    want = {}
    for d, x in docs:
        gone = np.zeros(len(x) + 1, int)
        for i in range(len(x) - 199):
            if times[x[i : i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        want[d] = (int(gone.sum()), hashlib.sha256(np.frombuffer(x.encode(), np.uint8)[~gone].tobytes()).hexdigest())
    assert sum(n for n, _ in want.values())
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in runindex.drop_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == want
