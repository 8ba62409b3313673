"""Operator 13 against plain Python over the tokenizers' own ids."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hard_rows import HARD
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pitfeat.llm import alignment, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabularies():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters)}
    s = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = [s.id_to_piece(i) for i in range(s.get_piece_size())]
    piece = [bytes([int(x[3:5], 16)]) if x.startswith("<0x") and len(x) == 6 else x.replace("▁", " ").encode() for x in names]
    return t, lambda i: bytes(byte[c] for c in t.id_to_token(i)), s, piece


def brute(vocabularies, rows):
    """Counter of result rows from (doc_id, text)."""
    t, a_bytes, s, b_bytes = vocabularies
    found, count = [], Counter()
    for d, text in rows:
        a = t.encode(" " + text, add_special_tokens=False).ids if text else []
        b = s.encode(text) if text else []
        ab, bb = [a_bytes(i) for i in a], [b_bytes[i] for i in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(ab) != raw or b"".join(bb) != raw:
            found.append((d, [], [], [], ""))
            continue
        a_end, b_end = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        groups, i, j, pairs = [], 0, 0, []
        for cut in sorted(set(a_end) & set(b_end)):
            k, m = a_end.index(cut, i) + 1, b_end.index(cut, j) + 1
            groups.append((a[i:k], b[j:m]))
            for x in range(i, k):
                for y in range(j, m):
                    if max(a_end[x] - len(ab[x]), b_end[y] - len(bb[y])) < min(a_end[x], b_end[y]):
                        pairs.append((a[x], b[y]))
            i, j = k, m
        text_of = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((d, a, b, pairs, hashlib.sha256(text_of.encode()).hexdigest(), len(groups)))
        count.update(pairs)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return Counter((d, len(a), len(b), g[0] if g else 0, len(p), sum(count[x] == most[x[1]] for x in p), sum(count[x] for x in p), h)
                   for d, a, b, p, h, *g in found)


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_documents(vocabularies, spark, docs):
    some = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert rows(queries.QUERIES["op13_alignment"](spark, SF)) == brute(vocabularies, some)


def test_hard_repeated_and_empty(vocabularies, spark, hard, empty, monkeypatch):
    some = [(r[0], r[1]) for r in HARD if len(r[1] or "") < 50_000]
    odd = [(20, "x▁y"), (21, "<|endoftext|><s></s><unk>"), (22, "a\x00b"), (23, "  two  spaces \n\n"), (24, "日本語のテキスト ok"), (25, "▁")]
    frame = spark.createDataFrame(some + odd, "doc_id long, text string")
    want = brute(vocabularies, some + odd)
    assert rows(alignment.align(frame)) == want
    assert {r[1] for r in want if r[0] in (20, 25)} == {0}
    twice = brute(vocabularies, (some + odd) * 2)
    assert rows(alignment.align(frame.union(frame))) == twice
    assert alignment.align(empty).count() == 0
    assert sum(rows(alignment.align(hard)).values()) == len(HARD)


def test_divide_finds_all_cuts():
    r = np.random.default_rng(2)
    for density in (0.02, 0.3, 0.9):
        a_end, b_end, a_first, b_first, base = [], [], [0], [0], 0
        for _ in range(60):
            n = int(r.integers(1, 300))
            for ends, first in ((a_end, a_first), (b_end, b_first)):
                own = sorted({*np.flatnonzero(r.random(n) < density).tolist(), n - 1})
                ends += [base + x + 1 for x in own]
                first.append(len(ends))
            base += n
        a, b = np.array(a_end), np.array(b_end)
        g = alignment.divide(a, b, np.array(a_first), np.array(b_first))
        common = np.intersect1d(a, b)
        assert (a[g.a[1:] - 1] == common).all() and (b[g.b[1:] - 1] == common).all()
        x, y = alignment.links(a, b)
        starts = [np.concatenate([[0], e[:-1]]) for e in (a, b)]
        want = {(i, j) for i in range(len(a)) for j in range(np.searchsorted(b, starts[0][i], "right"), len(b)) if starts[1][j] < a[i]}
        assert set(zip(x.tolist(), y.tolist(), strict=True)) == want and len(x) == len(want)


def test_cutless_interval_is_one_group():
    a, b = np.arange(2, 2002, 2), np.append(np.arange(1, 1999, 2), 2000)
    g = alignment.divide(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert g.a.tolist() == [0, 1000] and g.b.tolist() == [0, len(b)]


def test_pairs_keep_their_width():
    small, large = np.array([50_256 << 32 | 31_999, 1]), np.array([70_000 << 32 | 5])
    for p in (small, large, np.empty(0, np.int64)):
        assert (alignment._wide(alignment._narrow(p).tobytes(), len(p)) == p).all()
