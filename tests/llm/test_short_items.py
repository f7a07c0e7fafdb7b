"""Decontamination finds every window at the share, for items of every length."""

from itertools import combinations

from cytoframe.llm import decontam


def lost(n, masks):
    """Patterns of disagreeing words, as many as the share lets pass, that no mask avoids."""
    return [c for c in combinations(range(n), n - -(-8 * n // 10)) if not any(all(m[i - o] == "0" for i in c if o <= i < o + len(m)) for m in masks for o in range(n - len(m) + 1))]


def test_no_pattern_is_lost():
    assert not {n: lost(n, decontam.masks_for([n])) for n in range(1, 14) if lost(n, decontam.masks_for([n]))}


def test_items_of_every_length(spark):
    items, texts, want = [], [], set()
    for n in range(1, 15):
        words = [f"w{n}x{i}" for i in range(n)]
        items.append((n, " ".join(words)))
        size = min(n, 13)
        bound = size - -(-8 * size // 10)
        for k in (bound, bound + 1):
            for c in combinations(range(size), k):
                own = [("zz" if i in c else w) for i, w in enumerate(words[:size])]
                texts.append((len(texts), "before it " + " ".join(own) + " and after"))
                if k == bound:
                    want.add((len(texts) - 1, n))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, bench, short=True).collect()}
    assert want <= got
    assert all(sum(f"w{n}x{i}" in texts[d][1].split() for i in range(n)) >= 0.8 * min(n, 13) for d, n in got)
