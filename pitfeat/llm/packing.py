"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

Each document becomes the ids of a public tokenizer plus an end id. Whole
windows are cut off a long document's front; its rest is cut into pieces of at
most ``piece`` ids. Pieces gather, task by task, into blocks of about
``block_windows`` windows. Inside a block the differencing method deals them
into k windows: every piece starts as a partial partition (one filled window,
k - 1 empty ones); the two partial partitions with the largest imbalance merge
again and again, the fullest windows of one on the emptiest of the other, until
one partition with near-equal windows is left. k starts at the smallest
possible count and rises whenever a window exceeds the capacity.

Scale: no shuffle at all. A task holds one Arrow batch of texts and one block of
piece lengths (not ids); the windows of a task are numbered from its partition
id, which Spark keeps when it runs a lost task again. A hot source, repeated
rows or null ids change nothing, since nothing is grouped by them.

Defined results: null text counts as empty and yields the end id alone; an
empty table yields no rows; repeated rows are packed once per row; extra columns
are ignored; null doc_id stays null.
"""

from __future__ import annotations

import heapq
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_batch, worker_tables
from .pieces import LowerWords

CAPACITY = 4096
END_ID = 2

COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
BATCH = pa.schema([(c, pa.int64()) for c in COLUMNS])
SCHEMA = ", ".join(f"`{c}` long" for c in COLUMNS)


def encoder(name: str) -> LowerWords:
    """One encoder per Python worker and vocabulary."""
    return worker_tables(("packing", name), lambda: LowerWords(name))


def cuts(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document with n ids."""
    out = [(s, capacity) for s in range(0, n - n % capacity, capacity)]
    s = n - n % capacity
    while s < n:
        out.append((s, min(piece, n - s)))
        s += out[-1][1]
    return out


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Deal items into k parts by Karmarkar-Karp differencing; parts hold item numbers.

    A partial partition keeps only its filled parts, fullest first, as
    (sum, tree of items); its imbalance is fullest minus emptiest.
    """
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    if k == 1 or not heap:
        return [list(range(len(sizes)))] + [[] for _ in range(k - 1)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        both = len(a) + len(b) - k  # so many parts of each must share a window
        if both <= 0:
            c = a + b
        else:
            c = a[:len(a) - both] + b[:len(b) - both]
            c += [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[len(a) - both:], reversed(b[len(b) - both:]), strict=True)]
        c.sort(key=lambda x: -x[0])
        heapq.heappush(heap, (-(c[0][0] - (c[-1][0] if len(c) == k else 0)), n, c))
        n += 1
    parts = []
    for _, tree in heap[0][2]:
        items, stack = [], [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            else:
                items.append(x)
        parts.append(items)
    return parts + [[] for _ in range(k - len(parts))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts of at most ``capacity`` each: the count rises until no window exceeds it."""
    k = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, k)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return [p for p in parts if p]
        k += 1


def _tasks(name: str, capacity: int, piece: int, block_windows: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(name), np.array([end_id], "<u4")
        base = TaskContext.get().partitionId() << 40
        made, held, waiting = 0, 0, []

        def flush(rows):
            nonlocal made
            for part in windows([r[2] for r in rows], capacity):
                at = 0
                for i in sorted(part):
                    yield (*rows[i], base + made, at)
                    at += rows[i][2]
                made += 1

        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some, full = batch.slice(i, 64), []
                raws = encode(some.column("text").to_pylist())
                for d, raw in zip(some.column("doc_id").to_pylist(), raws, strict=True):
                    raw = np.concatenate([raw, end]).tobytes()
                    n = len(raw) // 4
                    for s, length in cuts(n, capacity, piece):
                        row = (d, s, length, zlib.crc32(raw[4 * s:4 * (s + length)]), n)
                        if length == capacity:
                            full.append((*row, base + made, 0))
                            made += 1
                        else:
                            waiting.append(row)
                            held += length
                if full:
                    yield rows_batch(full, BATCH)
                while held >= 2 * block_windows * capacity:  # the last block keeps at least one block's worth
                    took, now = 0, 0
                    while took < block_windows * capacity:
                        took += waiting[now][2]
                        now += 1
                    yield rows_batch(flush(waiting[:now]), BATCH)
                    waiting, held = waiting[now:], held - took
        if waiting:
            yield rows_batch(flush(waiting), BATCH)
    return run


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY,
         piece: int = 1024, block_windows: int = 256, end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``tokenizer`` is the name of a public vocabulary file or a path.
    """
    run = _tasks(tokenizer, capacity, min(piece, capacity), block_windows, end_id)
    return (docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
            .mapInArrow(run, SCHEMA))
