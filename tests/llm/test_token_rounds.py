"""Re-Pair goes on until no pair is frequent."""

import numpy as np

from cytoframe.llm import tokenfile


def test_no_frequent_pair_stays():
    g = np.random.default_rng(1)
    one = g.integers(1, 50_000, 500)
    for ids, counts in ((np.tile(one, 400), np.full(400, 500)), (np.full(100_000, 7), np.array([100_000])), (g.integers(1, 40, 20_000), np.array([20_000]))):
        row = tokenfile.block_row(0, 0, list(range(len(counts))), counts, ids.astype(np.int64))
        assert (tokenfile.block_ids(row) == ids).all()
        rules, _, s = tokenfile.parsed(row)
        ends = np.zeros(len(s), bool)
        each = np.concatenate([np.ones(tokenfile.FIRST_RULE, np.int64), tokenfile.parsed(row)[1]])[s]
        ends[np.isin(np.cumsum(each), np.cumsum(counts))] = True
        pairs, times = np.unique((s[:-1] << 16 | s[1:])[~ends[:-1]], return_counts=True)
        same = pairs >> 16 == pairs & 0xFFFF  # aaa holds two overlapping pairs and one replaceable
        assert len(rules) == (1 << 16) - tokenfile.FIRST_RULE or not (times[~same] >= tokenfile.LEAST).any()
