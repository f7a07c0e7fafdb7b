"""The learned operators against naive versions of their models."""

from itertools import product

import numpy as np

from cytoframe.llm import langid, toxicity


def test_marginals_are_sums_over_all_taggings():
    g = np.random.default_rng(1)
    counts = np.array([1, 0, 7, 3, 1])
    n = int(counts.sum())
    field = toxicity.Field(np.zeros(1), np.array([0.7, -0.2, 0.4, -1.0]), g.normal(0, 1, (2, 2)), np.zeros(3))
    x = g.normal(0, 2, (n, 3))
    got = field.marginals(x, counts)
    log_phi = x @ field.weights[:-1] + field.weights[-1]
    at = 0
    for k in counts:
        weight = np.zeros((k, 2))
        for tags in product((0, 1), repeat=int(k)):
            w = np.exp(sum(log_phi[at + i] for i, s in enumerate(tags) if s) + sum(field.moves[a, b] for a, b in zip(tags[:-1], tags[1:], strict=True)))
            for i, s in enumerate(tags):
                weight[i, s] += w
        if k:
            assert np.allclose(got[at : at + k], weight[:, 1] / weight.sum(1))
        at += k


def test_chain_of_many_tokens():
    """Blocks of the recurrence join without a seam."""
    g = np.random.default_rng(2)
    n = 5 * toxicity.BLOCK + 7
    field = toxicity.Field(np.zeros(1), np.array([1.0, 0.0]), np.array([[0.3, -1.0], [-0.5, 0.8]]), np.zeros(3))
    x = g.normal(0, 1.5, (n, 1))
    phi, a = np.stack([np.ones(n), np.exp(x[:, 0])], 1), np.exp(field.moves)
    alpha, beta = np.zeros((n, 2)), np.ones((n, 2))
    alpha[0] = phi[0] / phi[0].sum()
    for t in range(1, n):
        alpha[t] = (alpha[t - 1] @ a) * phi[t]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = a @ (phi[t + 1] * beta[t + 1])
        beta[t] /= beta[t].sum()
    p = alpha * beta
    assert np.allclose(field.marginals(x, np.array([n])), p[:, 1] / p.sum(1))


def naive_network(net, row):
    tops = []
    for w, f, b in zip(langid.WIDTHS, net.filters, net.bias, strict=True):
        z = np.array([sum(net.embed[row[i + j]].astype(float) @ f[j] for j in range(w)) for i in range(langid.WINDOW - w + 1)])
        tops.append(np.maximum((z + b).max(0), 0))
    z = np.concatenate(tops) @ net.out + net.out_bias
    return z - z.max() - np.log(np.exp(z - z.max()).sum())


def test_network_by_tables_and_by_convolution():
    g = np.random.default_rng(3)
    net = langid.ByteNet(["a", "b", "c"])
    rows = g.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    got = net.log_probabilities(rows, net.tables(), step=2)
    assert np.allclose(got, [naive_network(net, r) for r in rows], atol=1e-4)


def test_gradients_are_slopes():
    g = np.random.default_rng(4)
    net = langid.ByteNet(["a", "b"])
    rows, y, weight = g.integers(0, 256, (6, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0, 1, 0]), np.ones(2)
    loss = lambda: -np.mean([naive_network(net, r)[k] for r, k in zip(rows, y, strict=True)])
    found = net._gradients(rows, y, weight)
    for p, d in zip(net.weights(), found, strict=True):
        at = np.unravel_index(int(np.abs(d).argmax()), d.shape)
        old, step = p[at], np.float32(1e-2)
        p[at] = old + step
        high = loss()
        p[at] = old - step
        low = loss()
        p[at] = old
        assert np.isclose((high - low) / (2 * step), d[at], rtol=0.15, atol=2e-3)
