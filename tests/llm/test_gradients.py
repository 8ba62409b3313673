"""The fits' gradients by finite differences, and the field's pair marginals by enumeration."""

from itertools import product

import numpy as np

from pitfeat.llm import langid, quality


def test_quality_gradient_by_finite_differences():
    r = np.random.default_rng(1)
    sizes = np.array([3, 1, 5, 2])
    start, bag = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(4), sizes)
    z, labels, weights = r.normal(size=(sizes.sum(), 6)), np.array([1.0, 0.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5, 1.5])
    p = {"W": r.normal(size=(6, 4)), "b": r.normal(size=4), "V": r.normal(size=(4, 3)), "U": r.normal(size=(4, 3)),
         "w": r.normal(size=3), "c": r.normal(size=4), "d": np.array(0.3)}
    _, g = quality.gradient(p, z, start, bag, labels, weights)
    for k, a in p.items():
        for at in np.ndindex(a.shape):
            loss = []
            for step in (1e-6, -1e-6):
                moved = {**p, k: a.copy()}
                moved[k][at] += step
                loss.append(quality.gradient(moved, z, start, bag, labels, weights)[0])
            assert np.isclose(np.asarray(g[k])[at], (loss[0] - loss[1]) / 2e-6, rtol=1e-4, atol=1e-8), (k, at)


def paths(e, t):
    """(labels, weight) of every labelling of one chain."""
    for path in product(range(e.shape[1]), repeat=len(e)):
        yield path, np.exp(t).sum(axis=0)[path[0]] * np.exp(sum(e[i, s] for i, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])))


def test_pair_marginals_by_enumeration():
    r = np.random.default_rng(2)
    k, lengths = 3, np.array([4, 1, 5])
    e, t = r.normal(size=(10, k)), r.normal(size=(k, k))
    m = langid.marginals(e, lengths, t)
    at = np.array([1, 2, 3, 6, 7, 8, 9])  # words with a word before them in their chain
    got, begin = dict(zip(at.tolist(), langid._pairs(e, m, lengths, t, at))), 0
    for n in lengths:
        want = np.zeros((n, k, k))
        for path, w in paths(e[begin:begin + n], t):
            for i in range(1, n):
                want[i, path[i - 1], path[i]] += w
        for i in range(1, n):
            assert np.allclose(got[begin + i], want[i] / want[i].sum())
        begin += n


def test_field_gradient_by_finite_differences():
    """Marginals less labels are the likelihood's gradient, for word scores and for transitions."""
    r = np.random.default_rng(3)
    n, k = 5, 3
    e, t, gold = r.normal(size=(n, k)), r.normal(size=(k, k)), r.integers(0, k, n)

    def loss(e, t):
        every = list(paths(e, t))
        # the start's sum over transitions is a constant of the model's first word
        own = sum(e[i, s] for i, s in enumerate(gold)) + sum(t[a, b] for a, b in zip(gold, gold[1:])) + np.log(np.exp(t).sum(axis=0)[gold[0]])
        return np.log(sum(w for _, w in every)) - own

    m = langid.marginals(e, np.array([n]), t)
    pairs = langid._pairs(e, m, np.array([n]), t, np.arange(1, n))
    de = m.copy()
    de[np.arange(n), gold] -= 1
    dt = pairs.sum(axis=0)
    np.add.at(dt, (gold[:-1], gold[1:]), -1)
    for at in np.ndindex(e.shape):
        moved = [e.copy(), e.copy()]
        moved[0][at] += 1e-6
        moved[1][at] -= 1e-6
        assert np.isclose(de[at], (loss(moved[0], t) - loss(moved[1], t)) / 2e-6, atol=1e-6)
    # transitions between words; the part through the first word's start is left out of the fit's gradient
    start = np.exp(t) / np.exp(t).sum(axis=0)
    first = m[0] - np.eye(k)[gold[0]]
    for at in np.ndindex(t.shape):
        moved = [t.copy(), t.copy()]
        moved[0][at] += 1e-6
        moved[1][at] -= 1e-6
        whole = (loss(e, moved[0]) - loss(e, moved[1])) / 2e-6
        assert np.isclose(dt[at] + start[at] * first[at[1]], whole, atol=1e-6)
