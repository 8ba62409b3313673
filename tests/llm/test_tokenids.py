"""Operator 11 against the tokenizer's own ids, and the file format by round trips."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hard_rows import HARD
from tokenizers import Tokenizer

from pitfeat.llm import pieces, queries, tokenids

SF = "/root/testdata/sf0.01"


def brute(rows):
    """Sorted (doc_id, n_tokens, crc) of (doc_id, text) rows."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for d, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((d, len(ids), zlib.crc32(ids.tobytes())))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def check(found, rows):
    found = [tuple(r) for r in found]
    assert sorted([(d, n, c) for d, _, n, c in found], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) == brute(rows)
    at, before = 0, None
    for d, start, n, _ in sorted(found, key=lambda r: r[1]):
        assert start == at and (before is None or d is not None and d >= before)
        at, before = at + n, d


def test_documents(spark, docs):
    check(queries.QUERIES["op11_tokenids"](spark, SF).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_hard_and_empty(spark, hard, empty, tmp_path):
    manifest = tokenids.write_ids(hard, str(tmp_path / "a"), file_ids=5000)
    assert manifest.count() > 1  # a new file after so many ids
    check(tokenids.read_ids(manifest).collect(), [(r[0], r[1]) for r in HARD])
    assert tokenids.read_ids(tokenids.write_ids(empty)).count() == 0
    repeated = hard.union(hard).union(hard)
    check(tokenids.read_ids(tokenids.write_ids(repeated)).collect(), [(r[0], r[1]) for r in HARD] * 3)


def test_any_span_is_read_by_its_blocks(spark, hard, tmp_path):
    folder = str(tmp_path / "b")
    tokenids.write_ids(hard, folder, file_ids=20_000)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {tuple(t.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in HARD}
    rows = tokenids.read_ids(spark.read.parquet(f"{folder}/manifest")).collect()
    total = sum(r["n_tokens"] for r in rows)
    whole = tokenids.read_span(spark, folder, 0, total)
    assert len(whole) == total
    for r in rows:
        assert tuple(whole[r["start"]:r["start"] + r["n_tokens"]].tolist()) in want
    for a, n in ((0, 1), (1023, 2), (5000, 30_000), (total - 1, 1), (7, 0)):
        assert (tokenids.read_span(spark, folder, a, n) == whole[a:a + n]).all()


@pytest.mark.parametrize("width", range(33))
def test_packing_at_every_width(width):
    r = np.random.default_rng(width)
    v = r.integers(0, 1 << width, (3, tokenids.BLOCK), dtype=np.uint64).astype(np.uint32)
    assert (tokenids.unpack(tokenids.pack(v, width), width) == v).all()


@pytest.mark.parametrize("n", [1, 5, 1023, 1024, 1025, 300_000])
def test_blocks_with_outliers(n):
    r = np.random.default_rng(n)
    ids = r.integers(100, 1000, n).astype(np.uint32)
    ids[r.random(n) < 0.01] = 2 ** 32 - 1
    blocks = tokenids.encode_blocks(ids)
    starts = np.cumsum([0] + [len(b) for b in blocks])
    assert (tokenids.decode_blocks(b"".join(blocks), starts[:-1])[:n] == ids).all()
    if n > 1024:  # ten bits an id and a few exceptions, not 32 bits
        assert starts[-1] < 1.6 * n
        assert tokenids.HEAD.unpack_from(blocks[0])[1] == 10


def test_documents_cross_blocks_and_flushes():
    r = np.random.default_rng(1)
    docs = [(i if i % 7 else None, r.integers(0, 50_257, int(r.integers(0, 3000))).astype(np.uint32)) for i in range(400)]
    docs.append((-5, r.integers(0, 50_257, 700_000).astype(np.uint32)))
    sink = pa.BufferOutputStream()
    out = tokenids.FileWriter(sink)
    for d, ids in docs:
        out.add(d, ids)
    out.close()
    reader = tokenids.FileReader(pa.BufferReader(sink.getvalue()))
    at = 0
    for (d, ids), got in zip(docs, reader.documents(), strict=True):
        assert got == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        assert (reader.span(at, len(ids)) == ids).all()
        at += len(ids)


ODD = ["", " ", "  a", "a  b", "a b ", " a\n b\n\nc  ", "x▁y z", "<|endoftext|> it's", "a<|endoftext|>b c", "it's I'LL 1234 don't've'd",
       "Ünï cödé \U0001F600 Σ ﬁ é​", "\x00 \x01", "日本語 テスト", "a　b c", "Ċ a Ċb", "a\x85 b", "a\r\n\tb \r\n x", "''s 's !'re"]


@pytest.mark.parametrize("text", ODD)
def test_cached_words_equal_whole_texts(text):
    a, b, c = pieces.ByteLevel("byte_bpe_50k.json"), pieces.ByteLevel("byte_bpe_50k.json", plain=True), pieces.SentencePiece("piece_bpe_32k.model")
    for x in (text, text + " tail", "head " + text):
        for _ in range(2):  # from the tokenizer, then from the cache
            assert a([x])[0].tolist() == a.exact(x)
            assert b([" " + x])[0].tolist() == b.exact(" " + x) and c([" " + x])[0].tolist() == c.exact(" " + x)


def test_chunks_and_a_cache_that_starts_anew(monkeypatch):
    e = pieces.ByteLevel("byte_bpe_50k.json")
    text = "some words, again; " * 300 + "x" * 5000 + "  two spaces\n and more"
    want = e.exact(text)
    for size in (1, 7, 100, 10 ** 6):
        assert "".join(pieces.chunks(text, size)) == text
    cut = pieces.chunks
    monkeypatch.setattr(pieces, "HELD", 10)
    monkeypatch.setattr(pieces, "chunks", lambda t: cut(t, 50))
    assert e([text, "b", text])[2].tolist() == want and len(cut(text, 50)) > 50
