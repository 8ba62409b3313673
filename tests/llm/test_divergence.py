"""Operator 12 against plain Python (and DuckDB, in test_sql)."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hard_rows import HARD

from pitfeat.llm import divergence


def brute(rows, least=3, top=200):
    """Rows of the audit from (text, lang, source)."""
    count, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)
        groups[lang].add(source)
        count[lang, source].update(words)
        df[lang].update(set(words))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        v = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return [1 + 10 ** 9 * (c[t] + 1) // (total + v) for t in kept]

        whole = Counter()
        for s in sources:
            whole += count[lang, s]
        q, p = shares(whole), {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum((a - b) ** 2 // b for a, b in zip(p[s], p[o], strict=True)), o) for o in sources if o != s]
            own = [((a - b) ** 2 // b, t) for a, b, t in zip(p[s], q, kept, strict=True) if count[lang, s][t] and a > b]
            for part, found in (("pair", pairs), ("term", own)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for i, (value, item) in enumerate(found[:top] if part == "term" else found):
                    out.add((lang, s, part, item, value, i + 1))
    return out


def check(df, rows, **kw):
    got = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, **kw)
    return got


def plain(df):
    return [(r["text"], r["lang"], r["source"]) for r in df.select("text", "lang", "source").collect()]


def test_documents(docs):
    some = docs.where("doc_id % 3 = 0")
    got = check(divergence.audit(some), plain(some))
    assert {g[2] for g in got} == {"pair", "term"} and max(g[5] for g in got) == 200


def test_hard_repeated_and_empty(hard, empty):
    rows = [(r[1], r[2], r[3]) for r in HARD]
    check(divergence.audit(hard, least_docs=1), rows, least=1)
    check(divergence.audit(hard.union(hard).union(hard)), rows * 3)
    check(divergence.audit(hard), rows)
    assert divergence.audit(empty).count() == 0


@pytest.mark.parametrize("shape", [(64, 400_000, 4096, 1_500_000), (2, 40, 3, 50), (1, 10, 2, 5)])
def test_cells_and_flushes_of_any_size(spark, monkeypatch, shape):
    for name, n in zip(("SOURCES", "CELL_ROWS", "CELL_TERMS", "ENTRIES"), shape, strict=True):
        monkeypatch.setattr(divergence, name, n)
    r = np.random.default_rng(4)
    words = ["a", "Bb", "bb", "Ж", "zz", "q", "w", "e", "one", "two", "é"]
    rows = []
    for i in range(120):
        source = "hot" if i % 3 == 0 else f"s{int(r.integers(7))}"
        text = " ".join(r.choice(words[:int(r.integers(1, 12))], int(r.integers(0, 9))))
        rows += [(text, "l1" if i % 5 else "l2", source)] * (1 + 6 * (i % 11 == 0))
    rows += [("--", "l3", "x"), ("!", "l3", "y"), ("word word word", "l4", "alone"), (None, None, None)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    check(divergence.audit(frame, least_docs=2, top=5), rows, least=2, top=5)


def test_merge_adds_equal_keys():
    a = np.array([[5, 1, 5], [1, 2, 3], [1, 1, 1]])
    assert divergence._merge([a, a]).tolist() == [[1, 5], [4, 8], [2, 4]]
    assert divergence._merge([np.empty((3, 0), np.int64)]).shape == (3, 0)


def test_terms_in_chunks():
    text = "Ab c,Ünï_xYz \n日本 " * 50 + "K" * 300
    whole = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.encode().lower().decode())
    for size in (1, 10, 1000, 10 ** 6):
        assert [w for part in divergence.terms(text, size) for w in part] == whole
    assert list(divergence.terms("")) == []
