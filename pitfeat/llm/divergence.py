"""Source divergence audit: how far the sources of a language differ in their words.

Duplicate-text collapse: the copies of a text in a language become one row with the
number of copies per source; it is tokenized once, and its terms count once per
copy in document frequencies and occurrences. The terms found in at least
``least_docs`` documents of a language are kept. A group (lang, source) gives a kept
term p = 1 + floor(10^9 (count + 1) / (N + V)), a language likewise q. Part ``term``
lists a group's own terms with p > q, part ``pair`` sums (p - q)^2 / q, floored, over
all kept terms for every ordered pair of sources.

Pairs are evaluated sparsely: where neither source has a term, both have their base
value, so a pair's sum is taken over the terms that its block of sources has and the
rest is counted times one constant. Sources are dealt into blocks of SOURCES; a cell
of two blocks and one bucket of terms adds up all its pairs in arrays and emits
one partial sum a pair, so no row is made for a pair's single term.

Scale: texts cross the network once, as one row per distinct text (a first row per
digest, map-side). A task numbers terms, adds up (group, term) entries in sorted
arrays of at most ENTRIES, and emits them when full; sums over (lang, source, term)
combine map-side, and a window sees one row per source of a term. Cells hold about
CELL_ROWS entries whatever the language's size. All arithmetic is in whole numbers
(decimal where a product passes 64 bits).

Defined results: null text, lang and source are ''; a text without terms adds
nothing, but its group is listed among the pairs; repeated rows are documents each; ties
rank by the item's UTF-8 bytes; a language without kept terms has pairs of value 0;
an empty table yields no rows; very long texts are read in chunks; extra columns are ignored.
"""

from __future__ import annotations

import re
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, materialize
from .langid import slices
from .pieces import Numbers

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
GAP = re.compile("[\x00-\x40\x5B-\x60\x7B-\x7F]")
CHUNK = 1 << 20
#: (group, term) entries that a task adds up before it emits them.
ENTRIES = 1_500_000
SOURCES = 64
CELL_ROWS = 400_000
CELL_TERMS = 4096  # columns of a cell's arrays at a time
SCALE = 10 ** 9


def terms(text: str, size: int = CHUNK) -> Iterator[list[str]]:
    """The text's terms, A-Z in lower case, about ``size`` characters at a time."""
    at = 0
    while at < len(text):
        cut = GAP.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield TERM.findall(text[at:end].encode().lower().decode())
        at = end


def collapsed(docs: DataFrame) -> DataFrame:
    """lang, text and sources (array of source and number of copies): one row per distinct text of a language."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").alias("text"))
    rows = rows.withColumn("d", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = rows.groupBy("lang", "d", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.groupBy("lang", "d").agg(F.collect_list(F.struct("source", "n")).alias("sources"))  # one entry a source
    return rows.groupBy("lang", "d").agg(F.first("text").alias("text")).join(copies, ["lang", "d"]).select("lang", "text", "sources")


def _merge(parts: list[np.ndarray]) -> np.ndarray:
    """Rows (key, occurrences, documents) with equal keys added up, sorted by key."""
    rows = np.concatenate(parts, axis=1)
    order = np.argsort(rows[0], kind="stable")
    rows = rows[:, order]
    first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]])) if rows.shape[1] else np.empty(0, np.int64)
    if not len(first):
        return rows
    return np.stack([rows[0, first], np.add.reduceat(rows[1], first), np.add.reduceat(rows[2], first)])


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    numbers, groups, held, n_new = Numbers(), Numbers(), [], 0

    def emit() -> Iterator[pa.RecordBatch]:
        rows, names, known = _merge(held), pa.array(list(numbers), pa.string()), list(groups)
        langs, sources = (pa.array([g[i] for g in known], pa.string()) for i in (0, 1))
        for a in range(0, rows.shape[1], 50_000):
            key, n, docs = rows[:, a:a + 50_000]
            g = pa.array(key >> 32)
            yield pa.RecordBatch.from_arrays([pc.take(langs, g), pc.take(sources, g), pc.take(names, pa.array(key & 0xFFFFFFFF)),
                                              pa.array(n), pa.array(docs)], schema=COUNTS)

    for batch in batches:
        for some in slices(batch, batch.column("text"), CHUNK):
            ids, n_terms, of, group, copies = [], [], [], [], []
            for i, (lang, text, sources) in enumerate(zip(*(some.column(c).to_pylist() for c in ("lang", "text", "sources")), strict=True)):
                found = [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in terms(text)]
                ids += found
                n_terms.append(sum(map(len, found)))
                for s in sources:
                    of.append(i)
                    group.append(groups[lang, s["source"]])
                    copies.append(s["n"])
            # distinct terms of each text, then one entry per source that has the text
            key = np.repeat(np.arange(some.num_rows) << 32, n_terms) | np.concatenate([*ids, np.empty(0, np.int64)])
            key, k = np.unique(key, return_counts=True)
            text, term = key >> 32, key & 0xFFFFFFFF
            begin, end = np.searchsorted(text, np.array(of)), np.searchsorted(text, np.array(of), "right")
            size = end - begin
            at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
            weight = np.repeat(copies, size)
            held.append(np.stack([np.repeat(np.array(group, np.int64) << 32, size) | term[at], k[at] * weight, weight]))
            n_new += len(at)
            if n_new > entries or len(numbers) > entries:
                held, n_new = [_merge(held)], 0
                if held[0].shape[1] > entries // 2 or len(numbers) > entries:
                    yield from emit()
                    numbers, groups, held = Numbers(), Numbers(), []
    if held:
        yield from emit()


def share(count: str, total: str, v: str = "v") -> Column:
    """1 + floor(SCALE (count + 1) / (total + v)); 1 where there are no terms."""
    return F.expr(f"CASE WHEN {v} = 0 THEN 1L ELSE 1L + ((cast({SCALE} as decimal(38, 0)) * ({count} + 1)) div ({total} + {v})) END").cast("long")


def counts(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, n, lang_n of the kept terms; ``one`` marks one row per (lang, term). A written table."""
    entries = ENTRIES
    parts = collapsed(docs).mapInArrow(lambda batches: _count(batches, entries), "lang string, source string, term string, n long, docs long")
    summed = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    kept = summed.select("lang", "source", "term", "n", F.sum("docs").over(same).alias("df"), F.sum("n").over(same).alias("lang_n"),
                         (F.min("source").over(same) == F.col("source")).alias("one"))
    return materialize(kept.where(F.col("df") >= least_docs).drop("df"), name="divergence-counts")


def totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Per (lang, source): its number i in the language, its total, the language's, and V. A written table of a row a group."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("one"), F.col("lang_n"))).alias("lang_total"),
                                             F.count(F.when(F.col("one"), 1)).alias("v"), F.count(F.lit(1)).alias("n_rows"))
    lang = Window.partitionBy("lang")
    whole = lambda c: F.coalesce(F.sum(c).over(lang), F.lit(0)).cast("long").alias(c)
    out = groups.join(own, ["lang", "source"], "left").select(
        "lang", "source", (F.row_number().over(lang.orderBy("source")) - 1).alias("i"), F.count(F.lit(1)).over(lang).alias("n_sources"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"), whole("lang_total"), whole("v"), whole("n_rows"))
    return materialize(out, name="divergence-totals")


PAIRS = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("value", pa.int64()), ("covered", pa.int64())])


def _cell(table: pa.Table, per_block: int, columns: int) -> pa.Table:
    """Partial sums of all ordered pairs between a cell's two blocks, over the terms the cell has."""
    lang, x, y = (table.column(c)[0].as_py() for c in ("lang", "x", "y"))
    i, p = table.column("i").to_numpy(), table.column("p").to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode()
    code = np.asarray(term.indices.fill_null(-1))
    n_terms = len(term.dictionary)
    base = code < 0
    sources, at = np.unique(i[base], return_index=True)
    p0 = p[base][at]
    row, code, p = np.searchsorted(sources, i[~base]), code[~base], p[~base]
    order = np.argsort(code, kind="stable")
    row, code, p = row[order], code[order], p[order]
    left, right = np.flatnonzero(sources // per_block == x), np.flatnonzero(sources // per_block == y)
    there, back = np.zeros((len(left), len(right)), np.int64), np.zeros((len(left), len(right)), np.int64)
    for a in range(0, n_terms, columns):
        own = slice(*np.searchsorted(code, [a, a + columns]))
        m = np.repeat(p0[:, None], min(columns, n_terms - a), axis=1)
        m[row[own], code[own] - a] = p[own]
        q = m[right]
        for k, s in enumerate(left):
            square = (m[s] - q) ** 2
            there[k] += (square // q).sum(axis=1)
            if x != y:
                back[k] += (square // m[s]).sum(axis=1)
    a, b = (z.ravel() for z in np.meshgrid(sources[left], sources[right], indexing="ij"))
    if x == y:
        other = a != b
        a, b, value = a[other], b[other], there.ravel()[other]
    else:
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([there.ravel(), back.ravel()])
    return pa.Table.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(a)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.int64()),
                                 pa.repeat(pa.scalar(n_terms, pa.int64()), len(a))], schema=PAIRS)


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources) and the value of b's shares seen from a's, summed over all kept terms."""
    blocks = F.ceil(F.col("n_sources") / F.lit(SOURCES)).cast("long")
    buckets = F.greatest(F.lit(1), F.ceil(2 * F.col("n_rows") / (blocks * F.lit(CELL_ROWS)))).cast("long")
    many = groups.where("n_sources > 1").withColumn("blocks", blocks).withColumn("buckets", buckets)
    g = many.select(F.col("lang").alias("l"), F.col("source").alias("s"), "i", "total", "v", "blocks", "buckets")
    rows = join_small(kept.select("lang", "source", "term", "n"), g, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "inner")
    rows = rows.select("lang", "i", "term", share("n", "total").alias("p"), "blocks", F.pmod(F.xxhash64("term"), F.col("buckets")).alias("bucket"))
    base = many.select("lang", "i", F.lit(None).cast("string").alias("term"), share("0L", "total").alias("p"), "blocks",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"))
    rows = rows.union(base).withColumn("own", F.floor(F.col("i") / F.lit(SOURCES)).cast("long"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("lang", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "bucket", F.col("i").cast("long").alias("i"), "term", "p")
    per_block, columns = SOURCES, CELL_TERMS
    sums = rows.groupBy("lang", "x", "y", "bucket").applyInArrow(lambda t: _cell(t, per_block, columns), "lang string, a long, b long, value long, covered long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("covered").alias("covered"))


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank."""
    kept = counts(docs, least_docs)
    groups = totals(docs, kept)

    g = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "total", "lang_total", "v")
    term = join_small(kept, g, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "inner")
    term = term.select("lang", "source", F.col("term").alias("item"), share("n", "total").alias("p"), share("lang_n", "lang_total").alias("q"))
    term = term.where("p > q").select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div q").alias("value"))

    sums = pair_sums(kept, groups)
    side = lambda n: groups.select(F.col("lang").alias(f"l{n}"), F.col("i").alias(f"i{n}"), F.col("source").alias(f"s{n}"),
                                   share("0L", "total").alias(f"p{n}"), F.col("v").alias(f"v{n}"))
    pair = join_small(sums, side(1), (F.col("lang") == F.col("l1")) & (F.col("a") == F.col("i1")), "inner")
    pair = join_small(pair, side(2), (F.col("lang") == F.col("l2")) & (F.col("b") == F.col("i2")), "inner")
    rest = F.expr("(v1 - covered) * (((p1 - p2) * (p1 - p2)) div p2)")
    pair = pair.select("lang", F.col("s1").alias("source"), F.lit("pair").alias("part"), F.col("s2").alias("item"), (F.col("value") + rest).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pair, term)]
    return ranked[0].union(ranked[1].where(F.col("rank") <= top))
