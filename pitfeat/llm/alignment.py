"""Cross-tokenizer alignment by divide and conquer at shared cuts.

A text's tokens by tokenizer A and by tokenizer B cover the same bytes, a space and
the text. Byte offsets where a token of both ends are cuts. An interval of tokens
looks for a cut near the middle of its A tokens: the end there is bisected among B's
ends; where it misses, the next B end is bisected among A's, and so on to the right.
A cut found parts the interval; both halves recurse, and what was searched is not
searched again. An interval whose candidates are used up is a leaf group. All
intervals of a batch of texts go down level by level in arrays.

Inside a group, tokens of A and B whose bytes overlap are linked. Links are
counted per pair of ids over the corpus; a link is best if its pair's count is the
highest of its B id.

Scale: texts are encoded once. Each block of texts (about BLOCK bytes) gives one row
a document with its links (pairs of ids in one array) and one row per
distinct pair with its number in the block; both are written once. Pair counts
are summed with map-side combining; each block then asks only for its own distinct
pairs, so the join carries a row per (block, pair), not per link, and a very
frequent pair one row a block, which AQE may split. Blocks meet their counts in
a cogroup of bounded size. Nothing depends on how often a text or source repeats.

Defined results: null and empty texts, and texts whose joined token bytes differ from
space + text for A or B, have zeros and ''; special tokens' strings are plain
text; a null doc_id stays null; repeated rows count their links each; an empty
table yields no rows; very long texts are encoded in chunks and make a block of
their own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, rows_batch, worker_tables
from .langid import slices
from .pieces import ByteLevel, SentencePiece

BLOCK = 1 << 21


@dataclass
class Groups:
    """Leaf groups in order: A tokens a[i]:a[i + 1] and B tokens b[i]:b[i + 1] cover the same bytes."""
    a: np.ndarray
    b: np.ndarray


def divide(a_end: np.ndarray, b_end: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> Groups:
    """Groups of several texts laid end to end.

    ``a_end`` and ``b_end`` are ascending byte offsets of the tokens' ends; text i has
    the tokens a_first[i]:a_first[i + 1] and b_first[i]:b_first[i + 1], at least one each,
    and its last tokens end together.
    """
    a_lo, a_hi, b_lo, b_hi = a_first[:-1], a_first[1:], b_first[:-1], b_first[1:]
    from_, to = a_lo, a_hi - 1  # A tokens whose end may be an inner cut
    leaves = []
    while len(a_lo):
        leaf = from_ >= to
        if leaf.any():
            leaves.append(np.stack([a_lo[leaf], b_lo[leaf]]))
            a_lo, a_hi, b_lo, b_hi, from_, to = (x[~leaf] for x in (a_lo, a_hi, b_lo, b_hi, from_, to))
        middle = (from_ + to) // 2
        at, place, found = middle.copy(), np.zeros_like(middle), np.zeros(len(middle), bool)
        live = np.arange(len(middle))
        while len(live):  # the first common end from the middle on, before ``to``
            x = a_end[at[live]]
            j = np.searchsorted(b_end, x)
            y = b_end[j]
            hit = y == x
            found[live[hit]], place[live[hit]] = True, j[hit]
            live, y = live[~hit], y[~hit]
            at[live] = np.searchsorted(a_end, y)
            live = live[at[live] < to[live]]
        cut = found
        c, d = at[cut] + 1, place[cut] + 1  # the first tokens after the cut
        a_lo, a_hi = np.concatenate([a_lo, c]), np.concatenate([np.where(cut, at + 1, a_hi), a_hi[cut]])
        b_lo, b_hi = np.concatenate([b_lo, d]), np.concatenate([np.where(cut, place + 1, b_hi), b_hi[cut]])
        from_, to = np.concatenate([from_, c]), np.concatenate([middle, to[cut]])
    starts = np.concatenate(leaves, axis=1) if leaves else np.empty((2, 0), np.int64)
    starts = starts[:, np.argsort(starts[0], kind="stable")]
    return Groups(np.append(starts[0], len(a_end)), np.append(starts[1], len(b_end)))


def links(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping A and B tokens: between two neighbouring ends of either lies one token of both."""
    # both lists in one order, A's first where ends are equal; a stable sort merges sorted runs
    ends = np.sort(np.concatenate([a_end << 1, (b_end << 1) | 1]), kind="stable")
    of, is_b = ends >> 1, (ends & 1).astype(bool)
    first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.empty(0, np.int64)
    # tokens that end before an end's place: those among the ends listed before it
    before_b = np.cumsum(is_b)[first] - is_b[first]
    return first - before_b, before_b


class Aligner:
    """Both tokenizers, the byte lengths of their ids, and the strings of ids in a digest."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a, plain=True), SentencePiece(b)
        self.lengths = [np.array([len(x) for x in t.bytes], np.int64) for t in (self.a, self.b)]
        self.n = n = max(map(len, self.lengths))
        # decimal ids with the sign after them, padded with zero bytes to 8
        self.text = np.frombuffer(b"".join(f"{i}{sign}".encode().ljust(8, b"\0") for sign in (",", "|", ";") for i in range(n)), np.uint64)
        if len(self.text) != 3 * n:
            raise ValueError("ids of over seven digits")

    def __call__(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups, n_links, digest) of each text; the pairs of ids of all links; links per text."""
        some = [i for i, t in enumerate(texts) if t]
        raw = [" " + texts[i] for i in some]
        a, b = self.a.encode(raw, check=True), self.b.encode(raw, check=True)
        good = [k for k in range(len(raw)) if a[k][1] and b[k][1]]
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        per_text = np.zeros(len(texts), np.int64)
        if not good:
            return rows, np.empty(0, np.int64), per_text
        where = [some[k] for k in good]
        a, b = [a[k][0] for k in good], [b[k][0] for k in good]
        a_first, b_first = (np.concatenate([[0], np.cumsum([len(x) for x in ids])]) for ids in (a, b))
        a, b = np.concatenate(a).astype(np.int64), np.concatenate(b).astype(np.int64)
        a_end, b_end = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        g = divide(a_end, b_end, a_first, b_first)
        of_a, of_b = links(a_end, b_end)
        pairs = a[of_a] << 32 | b[of_b]
        n_links = np.diff(np.searchsorted(of_a, a_first))
        n_groups = np.diff(np.searchsorted(g.a, a_first))
        # tokens in the order of the digest, each with the sign that follows it
        sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        sign_a[g.a[1:] - 1], sign_b[g.b[1:] - 1] = 1, 2
        at_a = np.arange(len(a)) + np.repeat(g.b[:-1], np.diff(g.a))
        at_b = np.arange(len(b)) + np.repeat(g.a[1:], np.diff(g.b))
        code = np.empty(len(a) + len(b), np.int64)
        code[at_a], code[at_b] = sign_a * self.n + a, sign_b * self.n + b
        begin = a_first + b_first
        for k, i in enumerate(where):
            signs = self.text[code[begin[k]:begin[k + 1]]].view(np.uint8)
            own = signs[signs != 0].tobytes()[:-1]
            n_a, n_b = int(a_first[k + 1] - a_first[k]), int(b_first[k + 1] - b_first[k])
            rows[i] = (n_a, n_b, int(n_groups[k]), int(n_links[k]), hashlib.sha256(own).hexdigest())
        per_text[where] = n_links
        return rows, pairs, per_text


ROW = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                 ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("pair", pa.int64()), ("n", pa.int64())])
DDL = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, pair long, n long")


def _narrow(pairs: np.ndarray) -> np.ndarray:
    """Pairs of ids as 16 bits of A and 16 of B where all ids fit, else as they are."""
    if len(pairs) and ((pairs >> 32).max() >= 1 << 16 or (pairs & 0xFFFFFFFF).max() >= 1 << 16):
        return pairs
    return ((pairs >> 16) | (pairs & 0xFFFF)).astype(np.uint32)


def _wide(raw: bytes, n: int) -> np.ndarray:
    if len(raw) == 8 * n:
        return np.frombuffer(raw, np.int64)
    pairs = np.frombuffer(raw, np.uint32).astype(np.int64)
    return (pairs >> 16 << 32) | (pairs & 0xFFFF)


def _align(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = worker_tables(("alignment", a, b), lambda: Aligner(a, b))
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in slices(batch, batch.column("text"), BLOCK):
                rows, pairs, n = align(some.column("text").to_pylist())
                key, count = np.unique(pairs, return_counts=True)
                ends = np.cumsum(n).tolist()
                own = [_narrow(pairs[e - k:e]).tobytes() for e, k in zip(ends, n.tolist(), strict=True)]
                yield rows_batch([(block, d, *r, p, None, None) for d, r, p in zip(some.column("doc_id").to_pylist(), rows, own, strict=True)], ROW)
                null = lambda t, m=len(key): pa.nulls(m, t)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block)), *[null(f.type) for f in list(ROW)[1:8]],
                                                  pa.array(key), pa.array(count)], schema=ROW)
                block += 1
    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def _look_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with the counts of its pairs."""
    key, n, best = (counts.column(c).to_numpy() for c in ("pair", "count", "best"))
    order = np.argsort(key)
    key, n, best = key[order], n[order], best[order]
    sums, bests = [], []
    for raw, k in zip(docs.column("pairs").to_pylist(), docs.column("n_links").to_pylist(), strict=True):
        at = np.searchsorted(key, _wide(raw, k)) if k else np.empty(0, np.int64)
        sums.append(int(n[at].sum()))
        bests.append(int(best[at].sum()))
    cols = {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    return pa.Table.from_arrays([cols.get(f.name) if f.name in cols else docs.column(f.name) for f in RESULT], schema=RESULT)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair (A's id in the upper 32 bits, B's in the lower), count over all links, and 1 where it is its B id's highest."""
    counts = found.where(F.col("pair").isNotNull()).groupBy("pair").agg(F.sum("n").alias("count"))
    counts = materialize(counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)), name="alignment-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # a row a B id at most
    return counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """Per document: tokens of both, groups, links, best links, the links' counts added up and the digest of its groups.

    ``a`` (tokenizers library, byte-level) and ``b`` (sentence-piece) are names of public vocabulary files or paths.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = materialize(rows.mapInArrow(_align(a, b), DDL), name="alignment")
    counts = pair_counts(found)
    asked = found.where(F.col("pair").isNotNull()).select(F.col("block").alias("asks"), "pair").join(counts, "pair")
    whole = found.where(F.col("pair").isNull()).drop("pair", "n")
    return (whole.groupBy("block").cogroup(asked.groupBy("asks"))
            .applyInArrow(_look_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
