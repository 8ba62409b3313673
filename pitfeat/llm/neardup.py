"""Near-duplicate groups: banded MinHash, odd sketches, then exact sets.

1. One pass over the texts gives each document the digest of its set of word
   shingles, MinHash band keys and an odd sketch: the MinHash samples (i, value)
   folded into a bitmap by parity. The XOR of two sketches counts, by parity, the
   samples that differ, so its population count estimates the similarity; high
   similarities, where few samples differ, most precisely.
2. Documents with equal sets form a class with a number of its own; the rest works
   on these numbers, which aggregate by hash.
3. In each bucket of a band, every class is paired with the smallest one (a star,
   so pairs grow with the members, not with their square). Pairs pass the sketch,
   then the exact sets; links are contracted to components.
4. Buckets whose members beside the centre still lie in several components are
   compared whole (of buckets with the same members one is taken): members are
   dealt into blocks, block pairs into cells. A cell first compares sketches; the
   members with a promising partner in another component get their sets, and the
   cell verifies such pairs, closest first, skipping pairs it has joined. It
   gives back links that join components, fewer than its members.
5. Components of all links give each document the smallest reachable doc_id.

Bands of 4 rows, 32 of them, miss a pair of similarity 0.8 with probability
5e-8; the sketch is held against an estimate of 0.5, over six standard
deviations below 0.8.

Scale: equal sets are counted map-side; star centres are map-side minima; joins
on a hot centre or bucket are plain shuffled joins that AQE splits; cells bound
what a task holds; links and components stay in written tables.

Defined results: null or empty text, or text without words, has an empty set and
links with nothing; fewer words than a shingle form one; a row with a null doc_id
links with nothing, has component_id null and is kept; rows that repeat an id are
judged by their own text; an empty table yields no rows; extra columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_small, materialize, rows_batch, worker_tables

BANDS, ROWS = 32, 4
SKETCH_BITS = 512
LEAST = 0.5  # estimates from sketches below this are no candidates
CELL = 1024  # members of a block
U = np.uint64


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    w = [] if text is None else text.encode().lower().split()
    if not w:
        return np.empty(0, U)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), U, len(w))
    n = max(1, len(h) - words + 1)
    s = np.full(n, min(len(h), words), U)
    for i in range(min(words, len(h))):
        s = s * U(0x9E3779B97F4A7C15) + h[i:i + n]
        s ^= s >> U(29)
    s *= U(0xBF58476D1CE4E5B9)
    s ^= s >> U(32)
    return np.unique(s)


class Hashes:
    """The MinHash functions, band keys and odd sketches; fixed by a seed."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS, seed: int = 7):
        r = np.random.default_rng(seed)
        n = bands * rows
        self.bands, self.rows, self.bits = bands, rows, bits
        self.x = r.integers(0, 2 ** 63, n, dtype=np.uint64)
        self.a = r.integers(0, 2 ** 63, n, dtype=np.uint64) * U(2) + U(1)
        self.salt = r.integers(0, 2 ** 63, n, dtype=np.uint64)

    def samples(self, s: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), ~U(0), U)
        for i in range(0, len(s), 1024):
            least = np.minimum(least, ((s[i:i + 1024, None] ^ self.x) * self.a).min(axis=0))
        return least

    def keys(self, m: np.ndarray) -> np.ndarray:
        k = np.arange(self.bands, dtype=U)
        for row in m.reshape(self.bands, self.rows).T:
            k = (k ^ row) * U(0x9E3779B97F4A7C15)
            k ^= k >> U(31)
        return k.view(np.int64)

    def sketch(self, m: np.ndarray) -> np.ndarray:
        p = (m ^ self.salt) * U(0xD6E8FEB86659FD93)
        bit = ((p >> U(32)) % U(self.bits)).astype(np.int64)
        odd = np.bincount(bit, minlength=self.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)

    def most_bits(self, least: float) -> int:
        """XOR bits expected at similarity ``least``."""
        differing = 2 * len(self.a) * (1 - least)
        return int(self.bits / 2 * (1 - np.exp(-2 * differing / self.bits)))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sign(words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("t", pa.int64()), ("n", pa.int64()), ("c", pa.binary()),
                        ("bands", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = worker_tables("neardup", Hashes)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some, rows = batch.slice(i, 500), []
                for d, t, x in zip(*(some.column(c).to_pylist() for c in ("doc_id", "t", "text")), strict=True):
                    s = shingle_set(x, words)
                    if len(s):
                        m = h.samples(s)
                        rows.append((d, t, len(s), xxhash.xxh3_128_digest(s.tobytes()), h.keys(m), h.sketch(m)))
                    else:
                        rows.append((d, t, 0, None, None, None))
                yield rows_batch(rows, schema)
    return run


def signatures(docs: DataFrame, words: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), "text")
    return rows.mapInArrow(_sign(words), "doc_id long, t long, n long, c binary, bands array<long>, sketch array<long>")


def _sets(words: int):
    schema = pa.schema([("c", pa.int64()), ("s", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                yield rows_batch([(c, shingle_set(x, words).tobytes()) for c, x in zip(some.column("c").to_pylist(), some.column("text").to_pylist(), strict=True)], schema)
    return run


def shingle_sets(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(c, s): the sets of the given classes (c, rep, t), from the text of one member each."""
    of = classes.select("c", F.col("rep").alias("__rep"), F.col("t").alias("__t"))
    rows = join_small(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), of,
                      (F.col("doc_id") == F.col("__rep")) & (F.xxhash64("text") == F.col("__t")), "inner", 1_000_000)
    return rows.select("c", "text").mapInArrow(_sets(words), "c long, s binary").dropDuplicates(["c"])


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                rows = zip(*(some.column(c).to_pylist() for c in ("a", "b", "sa", "sb")), strict=True)
                yield rows_batch([(a, b) for a, b, x, y in rows if similar(np.frombuffer(x, U), np.frombuffer(y, U), percent)], schema)
    return run


def components(links: DataFrame) -> DataFrame:
    """(c, comp): the smallest reachable class of every linked class (large-star, small-star)."""
    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not larger:
            both = both.where(F.col("v") < F.col("u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        out = both.join(least, "u")
        if larger:
            out = out.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where(F.col("a") != F.col("b")).distinct()

    state = lambda e: e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), name="edges")
    now = state(edges)
    while now[0]:
        edges = materialize(star(star(edges, True), False), name="edges")
        was, now = now, state(edges)
        if was == now:
            break
    return (edges.select(F.col("a").alias("c"), F.col("b").alias("comp"))
            .union(edges.select(F.col("b").alias("c"), F.col("b").alias("comp")).distinct()))


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """XOR population counts of all pairs of two arrays of sketches, in strips of rows."""
    a, b = a.view(U), b.view(U)  # bitwise_count takes signed numbers by their absolute value
    out = np.zeros((len(a), len(b)), np.uint16)
    for i in range(0, len(a), 128):
        for k in range(a.shape[1]):
            out[i:i + 128] += np.bitwise_count(a[i:i + 128, k, None] ^ b[None, :, k])
    return out


def _promising(most: int):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        """Members of a cell with a close sketch in another component."""
        f = f.drop_duplicates("c").reset_index(drop=True)
        sketches = np.array(f["sketch"].tolist(), np.int64).reshape(len(f), -1)
        comp = pd.factorize(f["comp"])[0]
        near = (_differing(sketches, sketches) <= most) & (comp[:, None] != comp[None, :])
        return f.loc[near.any(axis=1), ["bk", "cell", "c", "comp", "sketch"]]
    return run


def _join_cell(most: int, percent: int):
    def run(f: pd.DataFrame) -> pd.DataFrame:
        """Links that join a cell's components, found closest pairs first."""
        f = f.drop_duplicates("c").reset_index(drop=True)
        sketches = np.array(f["sketch"].tolist(), np.int64).reshape(len(f), -1)
        sets = [np.frombuffer(s, U) for s in f["s"]]
        ids, comp, out = f["c"].tolist(), pd.factorize(f["comp"])[0], []
        z = _differing(sketches, sketches)
        i, j = np.nonzero(np.triu(z <= most, 1) & (comp[:, None] != comp[None, :]))
        for k in np.argsort(z[i, j], kind="stable"):
            a, b = i[k], j[k]
            if comp[a] != comp[b] and similar(sets[a], sets[b], percent):
                comp[comp == comp[b]] = comp[a]
                out.append((ids[a], ids[b]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def groups(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, t (hash of its text), n_shingles, component_id, kept."""
    return _grouped(docs, words, percent).drop("comp")


def _grouped(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``groups`` and ``comp``, which differs between groups of the same smallest id (null for rows in no group)."""
    most = Hashes().most_bits(LEAST)
    sig = materialize(signatures(docs, words), name="dedup-signatures")
    linked = sig.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(linked.groupBy("c").agg(
        F.min(F.struct("doc_id", "t")).alias("r"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .select(F.col("c").alias("digest"), F.monotonically_increasing_id().alias("c"), F.col("r.doc_id").alias("rep"), F.col("r.t").alias("t"),
                "bands", "sketch"), name="dedup-classes")  # numbered once: the table is written
    member = classes.select("c", F.explode("bands").alias("bk"))
    full = (member.groupBy("bk").agg(F.min("c").alias("centre"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("bk", "centre"))
    member = materialize(member.join(full, "bk"), name="dedup-buckets")

    sketch = classes.select("c", "sketch")
    pairs = member.where(F.col("c") != F.col("centre")).select(F.col("c").alias("a"), F.col("centre").alias("b")).distinct()
    close = (pairs.join(sketch.select(F.col("c").alias("a"), F.col("sketch").alias("x")), "a")
             .join(sketch.select(F.col("c").alias("b"), F.col("sketch").alias("y")), "b")
             .where(F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, v: s + v) <= most)
             .select("a", "b"))
    close = materialize(close, name="dedup-pairs")
    wanted = close.select(F.col("a").alias("c")).union(close.select(F.col("b").alias("c"))).distinct()
    sets = materialize(shingle_sets(docs, materialize(classes.join(wanted, "c", "left_semi").select("c", "rep", "t"), name="dedup-wanted"), words), name="dedup-sets")
    links = (close.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
             .join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
             .select("a", "b", "sa", "sb").mapInArrow(_verify(percent), "a long, b long"))
    links = materialize(links, name="dedup-links")
    comp = materialize(components(links), name="dedup-components")

    # pairs with the centre are decided; what remains is the other members against each other
    member = member.where(F.col("c") != F.col("centre")).join(comp, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    same = [F.bit_xor(F.xxhash64("c", F.lit(i))).alias(f"h{i}") for i in range(2)]
    mixed = (member.groupBy("bk").agg(F.min("comp").alias("m"), F.max("comp").alias("x"), F.count(F.lit(1)).alias("size"), *same)
             .where(F.col("m") != F.col("x")).groupBy("size", "h0", "h1").agg(F.min("bk").alias("bk")))
    member = materialize(member.select("bk", "c", "comp").join(mixed, "bk").select("bk", "c", "comp", "size"), name="dedup-mixed")
    blocks = F.ceil(F.col("size") / F.lit(CELL))
    member = member.withColumn("i", F.pmod(F.xxhash64("c"), blocks))
    member = member.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    member = member.withColumn("cell", F.least("i", "j") * blocks + F.greatest("i", "j"))
    cells = member.join(sketch, "c").select("bk", "cell", "c", "comp", "sketch").groupBy("bk", "cell")
    close = materialize(cells.applyInPandas(_promising(most), "bk long, cell long, c long, comp long, sketch array<long>"), name="dedup-cells")
    wanted = close.select("c").distinct()
    have = materialize(classes.join(wanted, "c", "left_semi").select("c", "rep", "t"), name="dedup-wanted")
    sets = shingle_sets(docs, have, words)
    more = close.join(sets, "c").groupBy("bk", "cell").applyInPandas(_join_cell(most, percent), "a long, b long")
    more = materialize(more.distinct(), name="dedup-links")
    if not more.isEmpty():
        comp = materialize(components(links.union(more)), name="dedup-components")

    reach = classes.select("c", "digest", "rep").join(comp, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    least = reach.groupBy("comp").agg(F.min("rep").alias("component_id"))
    reach = reach.join(least, "comp").select(F.col("digest").alias("c"), "component_id", "comp")
    out = linked.select("doc_id", "t", "n", "c").join(reach, "c").select("doc_id", "t", "n", "component_id", "comp")
    rest = sig.where((F.col("n") == 0) | F.col("doc_id").isNull()).select("doc_id", "t", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("comp"))
    return out.union(rest).select("doc_id", "t", F.col("n").alias("n_shingles"), "component_id",
                                  F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "comp")


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group; of rows that agree in id and text, one stays.

    Where rows of a group share its smallest id, the text of the smallest hash stays.
    """
    names = docs.columns
    found = materialize(_grouped(docs, words, percent).where(F.col("doc_id").isNotNull())
                        .groupBy("doc_id", "t").agg(F.first("kept").alias("kept"), F.first("comp").alias("comp"),
                                                    F.count(F.lit(1)).alias("k")), name="dedup-kept")
    kin = found.where(F.col("kept") & F.col("comp").isNotNull()).groupBy("comp").agg(F.min("t").alias("__least"), F.count(F.lit(1)).alias("m"))
    kin = materialize(kin.where(F.col("m") > 1).select(F.col("comp").alias("__of"), "__least"), name="dedup-kin")
    other = F.coalesce(F.col("t") != F.col("__least"), F.lit(False))
    found = materialize(join_small(found, kin, F.col("comp") == F.col("__of"))
                        .select("doc_id", "t", (F.col("kept") & ~other).alias("kept"), "k"), name="dedup-kept")
    rows = docs.withColumn("__id", F.col("doc_id").cast("long")).withColumn("__t", F.xxhash64("text"))
    same = (F.col("__id") == F.col("__k_id")) & (F.col("__t") == F.col("__k_t"))
    key = lambda f: materialize(f.select(F.col("doc_id").alias("__k_id"), F.col("t").alias("__k_t")), name="dedup-keys")
    alone = join_small(rows, key(found.where(~F.col("kept") | (F.col("k") > 1))), same, "left_anti", 1_000_000)
    again = key(found.where(F.col("kept") & (F.col("k") > 1)))
    repeated = join_small(rows, again, same, "left_semi", 1_000_000).dropDuplicates(["__id", "__t"])
    return alone.unionByName(repeated).select(*[F.col(f"`{n}`") for n in names])
