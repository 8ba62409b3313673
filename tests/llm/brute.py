"""Plain Python versions of the operators' exact parts."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text, n):
    w = words(lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows, n=4, percent=80):
    """{doc_id: (set size, component)} of (doc_id, text) rows with distinct ids."""
    sets = {d: shingles(t, n) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_word = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by_word[x].append(d)
    shared = Counter()
    for ids in by_word.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                shared[a, b] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def base_statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def base_licenses(text):
    """n_words, n_base, first_word, last_word, base_labels."""
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))
    places, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def url_rule(host, path):
    rules = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
    fit = []
    for r in rules:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fit.append(r)
    best = max(fit, key=len, default=None)
    return best, rules.get(best)


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """{source: target} by resharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not full:
            target.update({s: level * w[s] for s in open_})
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def crc(text):
    return zlib.crc32((text or "").encode())


def mcd(x, floors, steps=25, keep=0.75):
    """(squared distances, least determinant): concentration steps from three starts (quantiles as order statistics)."""
    rank = lambda v, q: np.sort(v)[max(0, int(np.ceil(q * len(v))) - 1)]
    centre = np.array([rank(c, 0.5) for c in x.T])
    spread = np.array([max((rank(c, 0.75) - rank(c, 0.25)) / 1.349, f) for c, f in zip(x.T, floors, strict=True)])
    ridge = np.diag(np.square(floors))
    z = (x - centre) / spread
    size = np.linalg.norm(z, axis=1, keepdims=True)
    signs = np.divide(z, size, out=np.zeros_like(z), where=size > 0)
    shapes = [np.eye(x.shape[1]), np.cov(np.tanh(z).T, bias=True), signs.T @ signs / len(x) * x.shape[1]]
    dist = lambda m, s: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    found = []
    for n, shape in enumerate(shapes):
        m, s, det = centre, shape * np.outer(spread, spread) + ridge, np.inf
        for _ in range(steps):
            d = dist(m, s)
            near = x[d <= rank(d, keep)]
            m2, s2 = near.mean(axis=0), np.cov(near.T, bias=True) + ridge
            det2 = np.linalg.det(s2)
            if det2 >= det:
                break
            stop = det2 >= det * (1 - 1e-6)
            m, s, det = m2, s2, det2
            if stop:
                break
        found.append((det, n, m, s))
    det, _, m, s = min(found, key=lambda f: f[:2])
    d = dist(m, s)
    return d / max(rank(d, 0.5) / 4.351, 1.0), det
