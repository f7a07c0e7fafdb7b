"""op1_line_dedup_whole, also the pipeline's stage, against every earlier line."""

import hashlib
import random
import re

import numpy as np

from cytoframe.llm import linededup, queries

DATA = "/root/testdata/sf0.001"


def edits(a, b, limit):
    """Edit distance, or more than `limit`."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        if min(new) > limit:
            return limit + 1
        row = new
    return row[-1]


def near(a, b):
    n, m = len(a), len(b)
    limit = max(n, m) // 5
    if min(n, m) >= 5 and abs(n - m) <= limit and len(set(a) - set(b)) <= limit and edits(a, b, limit) <= limit:
        return True
    x, y = b" ".join(a).decode(), b" ".join(b).decode()
    return max(n, m) <= 10 and min(len(x), len(y)) >= 5 and abs(len(x) - len(y)) <= 1 and edits(x, y, 1) <= 1


def kept(texts):
    seen, want = {}, {}
    for doc in sorted(texts):
        lines = []
        for line in texts[doc].split("\n"):
            words = tuple(re.findall(rb"[^\x20\x09-\x0D]+", line.encode().lower()))
            if words and words not in seen:
                seen[words] = any(near(words, o) for o in seen)
                gone = seen[words]
            else:
                gone = bool(words)
            if not gone:
                lines.append(line)
        want[doc] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return want


def test_whole_table(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    assert {r.doc_id: r.kept_sha256 for r in queries.op1_line_dedup_whole(spark, DATA).collect()} == kept(texts)


def test_lines_of_every_length(spark):
    """Lines of 1 to 40 words with as many edits as are allowed and one more; split words; hot pieces."""
    g = random.Random(5)
    word = lambda: "".join(g.choice("abcdefghij") for _ in range(6))
    texts, at = {}, 0
    for n in range(1, 41):
        for more in (0, 0, 1):
            line = [word() for _ in range(n)]
            other = list(line)
            for p in g.sample(range(n), min(n, n // 5 + more)):
                other[p] = word() if g.random() < 0.6 else other[p] + " " + word() if g.random() < 0.5 else ""
            texts[at], texts[at + 1] = " ".join(line), " ".join(" ".join(other).split())
            at += 2
        texts[at] = " ".join(line)[:3] + " " + " ".join(line)[3:]
        texts[at + 1] = " ".join(["one two three four", *[word() for _ in range(8)]])
        at += 2
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in linededup.dedup_lines(rows, whole=True).collect()}
    want = kept(texts)
    assert len(set(want.values())) > 100 and got == want


def test_edit_bound():
    g = random.Random(6)
    pairs = []
    for _ in range(400):
        a = [g.randrange(1, 4) for _ in range(g.randrange(10, 60))]
        b = list(a)
        for _ in range(g.randrange(0, 14)):
            p = g.randrange(len(b))
            b[p : p + 1] = g.choice(([], [9], [b[p], 8]))
        pairs.append((a, b))
    want = [edits(a, b, 99) <= max(len(a), len(b)) // 5 for a, b in pairs]
    assert 50 < sum(want) < 350 and linededup.within_share([tuple(np.array(x, np.uint64) for x in p) for p in pairs]).tolist() == want
