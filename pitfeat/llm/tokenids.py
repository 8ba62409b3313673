"""Token ids in binary files of patched frame-of-reference blocks.

A block holds BLOCK ids. Its least id is subtracted; what is left is packed at the
width that the PERCENTILE-th percentile of the block needs, and the outliers'
upper bits go to an exception list (place, upper bits), which reading patches in.
A file is blocks, then an index: the documents' ids and lengths and where each
block starts, so that any run of ids is read by decoding its blocks only
(``read_span``). Documents come in ascending ``doc_id``, null first; equal ids in
the order of their text's hash.

File layout, little-endian: magic; per block: least id u32, width u8, 0 u8,
exceptions u16, packed words u32[32 * width], places u16[], upper bits u32[];
index: flags u8[docs] (1 where the id is not null), doc ids i64[docs], lengths
u64[docs], block starts u64[blocks + 1]; docs u64, ids u64, blocks u64, start of the index
u64, magic. The last block is padded with its least id.

Scale: one range shuffle of the texts on (doc_id, hash of text, salt), so neither a
repeated id nor equal rows meet in one task. A task encodes its range in Arrow batches,
holds the ids of FLUSH blocks and one file's index, and starts a new file after
``file_ids`` ids. Files bear names of their own attempt; the manifest, written by Spark,
lists those of the tasks that succeeded, so a lost executor's files are never read.
Each file's first id follows from a running sum over the manifest (a row a file).
Files lie below ``spark.checkpoint.dir`` unless a path is given; tasks open them
with ``pyarrow.fs`` (shared folders, HDFS, S3, GCS).

Defined results: a null or empty text has the end id alone; a null doc_id is
written, with a flag; repeated rows are written once each; special tokens' strings
get their ids as the library does by default; an empty table yields no files and
no rows; very long texts are encoded in chunks and decoded block by block; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialize, rows_batch, worker_tables
from .langid import slices
from .pieces import ByteLevel

BLOCK = 1024  # 32 lanes of 32 ids
LANES = BLOCK // 32
PERCENTILE = 98
FLUSH = 256  # blocks packed or decoded at once
FILE_IDS = 1 << 25
MAGIC = b"PFORIDS1"
HEAD, TAIL = struct.Struct("<IBBH"), struct.Struct("<QQQQ8s")
U = np.uint32


def pack(d: np.ndarray, width: int) -> np.ndarray:
    """Words of rows of BLOCK numbers below 2 ** width; id i of a row is number i // LANES of lane i % LANES."""
    v = d.reshape(len(d), 32, LANES)
    out = np.zeros((len(d), width, LANES), U)
    for j in range(32 if width else 0):
        at, shift = divmod(j * width, 32)
        out[:, at] |= v[:, j] << U(shift)
        if shift + width > 32:
            out[:, at + 1] |= v[:, j] >> U(32 - shift)
    return out.reshape(len(d), -1)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    w = words.reshape(len(words), width, LANES)
    out = np.zeros((len(words), 32, LANES), U)
    mask = U((1 << width) - 1)
    for j in range(32 if width else 0):
        at, shift = divmod(j * width, 32)
        x = w[:, at] >> U(shift)
        if shift + width > 32:
            x = x | (w[:, at + 1] << U(32 - shift))
        out[:, j] = x & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The bytes of each block of ids; the last one may be short."""
    n = -(-len(ids) // BLOCK)
    v = np.empty(n * BLOCK, U)
    v[:len(ids)] = ids
    v[len(ids):] = ids[(n - 1) * BLOCK:].min() if n else 0
    v = v.reshape(n, BLOCK)
    least = v.min(axis=1)
    d = v - least[:, None]
    k = max(0, int(np.ceil(BLOCK * percentile / 100)) - 1)
    widths = np.frexp(np.partition(d, k, axis=1)[:, k].astype(np.float64))[1]  # bits of a whole number
    out: list[bytes] = [b""] * n
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        over = d[rows] >> U(w) if w < 32 else np.zeros((len(rows), BLOCK), U)
        words = pack(d[rows] & U((1 << w) - 1), w)
        for i, r in enumerate(rows.tolist()):
            at = np.flatnonzero(over[i])
            out[r] = b"".join((HEAD.pack(int(least[r]), w, 0, len(at)), words[i].tobytes(),
                               at.astype("<u2").tobytes(), over[i, at].tobytes()))
    return out


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks that start at ``starts`` in ``raw``."""
    heads = [HEAD.unpack_from(raw, a) for a in starts.tolist()]
    out = np.empty((len(heads), BLOCK), U)
    for w in {h[1] for h in heads}:
        rows = [i for i, h in enumerate(heads) if h[1] == w]
        words = np.stack([np.frombuffer(raw, "<u4", LANES * w, int(starts[i]) + HEAD.size) for i in rows])
        values = unpack(words, w)
        for v, i in zip(values, rows, strict=True):
            least, _, _, n = heads[i]
            if n:
                at = int(starts[i]) + HEAD.size + 4 * LANES * w
                v[np.frombuffer(raw, "<u2", n, at)] |= np.frombuffer(raw, "<u4", n, at + 2 * n) << U(w)
            out[i] = v + U(least)
    return out.ravel()


class FileWriter:
    """Writes documents' ids to one file."""

    def __init__(self, stream, percentile: float = PERCENTILE):
        self.stream, self.percentile = stream, percentile
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.starts = [len(MAGIC)]
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= FLUSH * BLOCK:
            self._flush(self.n_held - self.n_held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.empty(0, U)
        for a in range(0, n, FLUSH * BLOCK):
            blocks = encode_blocks(ids[a:min(n, a + FLUSH * BLOCK)], self.percentile)
            self.stream.write(b"".join(blocks))
            self.starts += (self.starts[-1] + np.cumsum([len(b) for b in blocks])).tolist()
        self.held, self.n_held = [ids[n:].copy()], len(ids) - n

    def close(self) -> None:
        self._flush(self.n_held)
        there = np.array([d is not None for d in self.docs], np.uint8)
        ids = np.array([0 if d is None else d for d in self.docs], "<i8")
        self.stream.write(b"".join((there.tobytes(), ids.tobytes(), np.array(self.lengths, "<u8").tobytes(), np.array(self.starts, "<u8").tobytes(),
                                    TAIL.pack(len(ids), self.n_ids, len(self.starts) - 1, self.starts[-1], MAGIC))))
        self.stream.close()


class FileReader:
    """Reads a file's index at once and its ids block by block."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        stream.seek(size - TAIL.size)
        n_docs, self.n_ids, n_blocks, at, magic = TAIL.unpack(stream.read(TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        stream.seek(at)
        raw = stream.read(size - TAIL.size - at)
        there = np.frombuffer(raw, np.uint8, n_docs)
        ids = np.frombuffer(raw, "<i8", n_docs, n_docs)
        self.docs = [d if t else None for d, t in zip(ids.tolist(), there.tolist(), strict=True)]
        self.lengths = np.frombuffer(raw, "<u8", n_docs, 9 * n_docs).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", n_blocks + 1, 17 * n_docs).astype(np.int64)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of blocks first .. last - 1, the file's padding cut off."""
        a, b = int(self.starts[first]), int(self.starts[last])
        self.stream.seek(a)
        ids = decode_blocks(self.stream.read(b - a), self.starts[first:last] - a)
        return ids[:self.n_ids - first * BLOCK]

    def span(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from the file's ``first`` on, by the blocks that hold them."""
        if not count:
            return np.empty(0, U)
        b = first // BLOCK
        return self.blocks(b, -(-(first + count) // BLOCK))[first - b * BLOCK:][:count]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(doc_id, its first id's place in the file, its number of ids, their CRC-32)."""
        ids, at = np.empty(0, U), 0  # decoded ids from place ``at`` on
        block, n_blocks, begin = 0, len(self.starts) - 1, 0
        for doc, n in zip(self.docs, self.lengths.tolist(), strict=True):
            crc, done = 0, begin
            while done < begin + n:
                if done == at + len(ids):
                    at, last = done, min(n_blocks, block + FLUSH)
                    ids, block = self.blocks(block, last), last
                part = ids[done - at:begin + n - at]
                crc = zlib.crc32(part.tobytes(), crc)
                done += len(part)
            yield doc, begin, n, crc
            begin += n


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


MANIFEST = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("base", pa.int64())])


def _write(folder: str, name: str, end_id: int, file_ids: int, percentile: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = worker_tables(("tokenids", name), lambda: ByteLevel(name)), np.array([end_id], U)
        part, number, out, path = TaskContext.get().partitionId(), 0, None, ""

        def done() -> pa.RecordBatch:
            out.close()
            return rows_batch([(part, number, path, len(out.docs), out.n_ids)], MANIFEST)

        for batch in batches:
            for some in slices(batch, batch.column("text")):
                for doc, ids in zip(some.column("doc_id").to_pylist(), encode(some.column("text").to_pylist()), strict=True):
                    if out is None:
                        path = f"{folder}/{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids"
                        files, place = _open(path)
                        files.create_dir(place.rsplit("/", 1)[0], recursive=True)
                        out = FileWriter(files.open_output_stream(place), percentile)
                    out.add(doc, np.concatenate([ids, end]))
                    if out.n_ids >= file_ids:
                        yield done()
                        out, number = None, number + 1
        if out is not None:
            yield done()
    return run


def write_ids(docs: DataFrame, path: str | None = None, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2,
              file_ids: int = FILE_IDS, percentile: float = PERCENTILE) -> DataFrame:
    """Write all documents' ids to files below ``path``; the manifest: part, number, path, n_docs, n_ids and start.

    ``tokenizer`` is the name of a public vocabulary file or a path.
    """
    spark = docs.sparkSession
    folder = (path or scratch_path(spark, "token-ids")).rstrip("/")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("text")).withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    order = ["doc_id", "t", "salt"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ddl = "part long, number long, path string, n_docs long, n_ids long"
    files = materialize(rows.mapInArrow(_write(f"{folder}/ids", tokenizer, end_id, file_ids, percentile), ddl), name="token-files")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return materialize(files, f"{folder}/manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of every document, read from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                files, place = _open(path)
                with files.open_input_file(place) as stream:
                    rows = []
                    for row in FileReader(stream).documents():
                        rows.append((*row, base))
                        if len(rows) >= 50_000:
                            yield rows_batch(rows, DIGEST)
                            rows = []
                    yield rows_batch(rows, DIGEST)

    n = max(1, manifest.count())  # a row a file
    found = (manifest.select("path", "start").repartition(n, "path")
             .mapInArrow(run, "doc_id long, at long, n_tokens long, ids_crc32 long, base long"))
    return found.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def read_span(spark: SparkSession, folder: str, first: int, count: int) -> np.ndarray:
    """Ids ``first`` .. ``first + count - 1`` of all files, by the blocks that hold them; for looking into a corpus."""
    m = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    rows = m.where((F.col("start") < first + count) & (F.col("start") + F.col("n_ids") > first)).orderBy("start").select("path", "start", "n_ids").collect()
    out = []
    for path, start, n in rows:
        files, place = _open(path)
        with files.open_input_file(place) as stream:
            a, b = max(first, start), min(first + count, start + n)
            out.append(FileReader(stream).span(a - start, b - a))
    return np.concatenate(out) if out else np.empty(0, U)
