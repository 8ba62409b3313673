"""Language identification of code-switched text by a linear-chain conditional random field.

Every word of a text is labelled: features are its affixes, its character
2- and 3-grams, the word itself and its entry in a lexicon of words that belong
to one language; transitions between languages are learned. Forward-backward
gives each word's probabilities; a document's language is the one with the
largest sum over its words, and its score is that sum's share. A run of over 24
letters (text without spaces, say) counts as several words: its pieces of 24
letters, which take the neighbouring letters for their n-grams, so that each
letter is read and weighs alike.

The fit uses a bounded sample: at most ``per_lang`` documents a language of at
most ``longest`` characters, chosen by a hash of their id. Training sequences
join stretches of different documents, so that the transitions see switches. The
likelihood's gradient (forward-backward marginals minus labels) drives Adagrad,
in numpy on the driver, the same at every run. Labelling covers whole texts.

Scale: one narrow pass; a task holds one Arrow batch. Texts are labelled in
blocks of 32 words at once: transfer matrices of all blocks, then entry vectors
from block to block, then marginals inside, which equals the pass over the
whole chain. Weights of words seen are kept in a bounded cache.

Defined results: a text that is null or has no letter gives ``und`` with score 0;
without a learnable document every text does; a null doc_id is never learned
from and is not held out; ties go to the smaller language; repeated rows agree;
an empty table yields no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, place, rows_batch, worker_tables
from .quality import remainder

WORDS = re.compile(r"[^\W\d_]+")
CHARS = 24  # of a word; a longer run becomes several
AFTER, BEFORE = "\x1e", "\x1f"  # parts the letter before (after) a piece of a run from it
BUCKETS = 1 << 15
BLOCK = 32
KEEP = 200_000  # words in a task's cache


def split(text: str | None) -> list[str]:
    """Lower-cased runs of letters, long ones in pieces; none if the text has no letter."""
    words = WORDS.findall((text or "").lower())
    if not any(c.isalpha() for w in words for c in w):
        return []
    return [p for w in words for p in (pieces(w) if len(w) > CHARS else (w,))] if max(map(len, words)) > CHARS else words


def pieces(run: str) -> list[str]:
    """Consecutive pieces of a long run, each with its neighbouring letters marked."""
    return [(run[a - 1] + AFTER if a else "") + run[a:a + CHARS] + (BEFORE + run[a + CHARS] if a + CHARS < len(run) else "")
            for a in range(0, len(run), CHARS)]


def word_features(words: list[str], lexicon: dict[str, int]) -> np.ndarray:
    """Feature buckets of each word; bucket 0 is none. Lexicon entries follow after BUCKETS."""
    n = len(words)
    before = np.array([ord(w[0]) if w[1:2] == AFTER else 1 for w in words], np.uint64)
    after = np.array([ord(w[-1]) if w[-2:-1] == BEFORE else 2 for w in words], np.uint64)
    bare = [w[2 * (w[1:2] == AFTER):len(w) - 2 * (w[-2:-1] == BEFORE)] for w in words]
    m = np.zeros((n, CHARS + 2), np.uint64)
    m[:, 0] = before
    m[:, 1:-1] = np.array(bare, f"<U{CHARS}").view(np.uint32).reshape(n, CHARS)
    length = (m != 0).sum(axis=1)  # with the mark or letter before
    m[np.arange(n), length] = after
    a, out = np.uint64(0x9E3779B97F4A7C15), []

    def bucket(h: np.ndarray, there: np.ndarray) -> None:
        h = h * a
        h ^= h >> np.uint64(33)
        out.append(np.where(there, 1 + (h * a >> np.uint64(40)) % np.uint64(BUCKETS - 1), 0).astype(np.int32))

    two = (m[:, :-1] * a + m[:, 1:] + np.uint64(7)) * a
    three = (two[:, :-1] + m[:, 2:] + np.uint64(13)) * a
    bucket(two, m[:, 1:] != 0)
    bucket(three, m[:, 2:] != 0)
    four = (three[:, 0] + m[:, 3] + np.uint64(17)) * a  # prefix of three letters
    bucket(four[:, None], ((m[:, 3] != 0) & (before == 1))[:, None])
    tail = np.array([w[-4:].rjust(4) for w in bare], "<U4").view(np.uint32).reshape(n, 4).astype(np.uint64)
    end = np.full(n, 19, np.uint64)
    for k in range(1, 5):  # suffixes of one to four letters
        end = (end + tail[:, 4 - k]) * a ^ np.uint64(k)
        bucket(end[:, None], ((length > k) & (after == 2))[:, None])
    whole = np.full(n, 23, np.uint64)
    for k in range(CHARS + 2):
        whole = (whole ^ m[:, k]) * a
        whole ^= whole >> np.uint64(29)
    bucket(whole[:, None], np.ones((n, 1), bool))
    out.append(np.array([lexicon.get(w, 0) for w in words], np.int32)[:, None])
    return np.concatenate([o if o.ndim == 2 else o[:, None] for o in out], axis=1)


def marginals(e: np.ndarray, lengths: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Forward-backward over chains of word scores ``e`` (words x languages), laid end to end; no length is 0."""
    k = e.shape[1]
    n_blocks = -(-lengths // BLOCK)
    first = np.concatenate([[0], np.cumsum(n_blocks)])
    chain = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(e)) - np.concatenate([[0], np.cumsum(lengths)])[chain]
    block, step = first[chain] + place // BLOCK, place % BLOCK
    total = first[-1]
    psi = np.ones((BLOCK, total, k))
    psi[step, block] = np.exp(e - e.max(axis=1, keepdims=True))
    there = np.zeros((BLOCK, total), bool)
    there[step, block] = True
    t = np.exp(transition - transition.max())

    through = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for s in range(BLOCK):
        new = (through.reshape(-1, k) @ t).reshape(total, k, k) * psi[s][:, None, :]
        new /= new.max(axis=(1, 2), keepdims=True)
        through = np.where(there[s][:, None, None], new, through)
    enter, leave = np.ones((total, k)), np.ones((total, k))
    for j in range(1, int(n_blocks.max())):
        b = first[:-1][n_blocks > j] + j
        v = np.einsum("bi,bij->bj", enter[b - 1], through[b - 1])
        enter[b] = v / v.max(axis=1, keepdims=True)
    for j in range(int(n_blocks.max()) - 1, 0, -1):
        b = first[:-1][n_blocks > j] + j
        v = np.einsum("bij,bj->bi", through[b], leave[b])
        leave[b - 1] = v / v.max(axis=1, keepdims=True)
    alpha = np.empty((BLOCK, total, k))
    v = enter
    for s in range(BLOCK):
        new = (v @ t) * psi[s]
        new /= new.max(axis=1, keepdims=True)
        v = np.where(there[s][:, None], new, v)
        alpha[s] = v
    out = np.empty((BLOCK, total, k))
    w = leave
    for s in range(BLOCK - 1, -1, -1):
        out[s] = alpha[s] * w
        new = (w * psi[s]) @ t.T
        new /= new.max(axis=1, keepdims=True)
        w = np.where(there[s][:, None], new, w)
    m = out[step, block]
    return m / m.sum(axis=1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray
    transition: np.ndarray
    lexicon: dict[str, int]
    met: np.ndarray  # [feature, language]: the fit met it in a word of the language
    cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def rows(self, words: list[list[str]]) -> np.ndarray:
        """Of all words, one after the other: scores, numbers of features that the fit met in each language, and number of features."""
        seen = self.cache
        if not seen or len(seen["at"]) > KEEP:
            seen.update(at={}, rows=np.empty((0, 2 * len(self.langs) + 1), np.float32))
        new = list(set().union(*words).difference(seen["at"]))
        if new:
            parts = [seen["rows"]]
            for i in range(0, len(new), 10_000):
                f = word_features(new[i:i + 10_000], self.lexicon)
                there = f > 0
                parts.append(np.column_stack([self.weights[f].sum(axis=1), (self.met[f] & there[:, :, None]).sum(axis=1), there.sum(axis=1)]).astype(np.float32))
            n = len(seen["at"])
            seen["at"].update(zip(new, range(n, n + len(new)), strict=True))
            seen["rows"] = np.concatenate(parts)
        at = np.fromiter((i for w in words for i in map(seen["at"].__getitem__, w)), np.int64, sum(map(len, words)))
        return seen["rows"][at]

    def emissions(self, words: list[list[str]]) -> np.ndarray:
        """Scores of all words, one after the other."""
        return self.rows(words)[:, :len(self.langs)].astype(np.float64)

    def identify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Each text's language, as ``label`` gives it, and its evidence: the share of its features (n-grams,
        affixes, words) that the fit has met in the languages which the field gives their words; 0 without letters."""
        words = [split(t) for t in texts] if self.langs else [[] for _ in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        langs, evidence, k = ["und"] * len(texts), np.zeros(len(texts)), len(self.langs)
        some = np.flatnonzero(lengths)
        if len(some):
            rows = self.rows([words[i] for i in some]).astype(np.float64)
            m = marginals(rows[:, :k], lengths[some], self.transition)
            begin = np.concatenate([[0], np.cumsum(lengths[some])])[:-1]
            for i, n in zip(some, np.add.reduceat(m, begin, axis=0).argmax(axis=1), strict=True):
                langs[i] = self.langs[n]
            met = (m * rows[:, k:2 * k]).sum(axis=1)
            evidence[some] = np.add.reduceat(met, begin) / np.add.reduceat(rows[:, -1], begin)
        return langs, evidence

    def label(self, texts: list[str | None], spans: bool = False) -> list[tuple]:
        """(language, score[, runs of words (language, first, last)]) of each text."""
        words = [split(t) for t in texts] if self.langs else [[] for _ in texts]
        lengths = np.array([len(w) for w in words], np.int64)
        none = ("und", 0.0, []) if spans else ("und", 0.0)
        out = [none] * len(texts)
        some = np.flatnonzero(lengths)
        if not len(some):
            return out
        m = marginals(self.emissions([words[i] for i in some]), lengths[some], self.transition)
        begin = np.concatenate([[0], np.cumsum(lengths[some])])
        sums = np.add.reduceat(m, begin[:-1], axis=0)
        for n, i in enumerate(some):
            k = int(sums[n].argmax())
            out[i] = (self.langs[k], min(1.0, float(sums[n, k] / lengths[i])))
            if spans:
                tag = m[begin[n]:begin[n + 1]].argmax(axis=1)
                cut = np.flatnonzero(np.diff(tag)) + 1
                out[i] += ([{"lang": self.langs[tag[a]], "first": int(a), "last": int(b) - 1}
                            for a, b in zip([0, *cut], [*cut, len(tag)], strict=True)],)
        return out


def fit(rows: list[tuple[str, str]], stretch: int = 8, parts: int = 4, sequences: int = 6000, epochs: int = 3,
        batch: int = 64, rate: float = 0.15, seed: int = 13) -> Model:
    """A model from (language, text) rows."""
    by = defaultdict(list)
    for lang, text in rows:
        if w := split(text):
            by[lang].append(w)
    langs = sorted(by)
    if not langs:
        return Model([], np.zeros((1, 0), np.float32), np.zeros((0, 0)), {}, np.zeros((1, 0), bool))
    k = len(langs)
    counts = [Counter(w for doc in by[x] for w in doc) for x in langs]
    lexicon = {}
    for i, c in enumerate(counts):
        for w, n in c.items():
            if n >= 5 and n >= 0.95 * sum(d[w] for d in counts):
                lexicon[w] = BUCKETS + i
    r = np.random.default_rng(seed)
    vocab: dict[str, int] = {}
    seq, tags = [], []
    for _ in range(sequences):
        words, labels, lang = [], [], int(r.integers(k))
        for _ in range(parts):
            docs = by[langs[lang]]
            doc = docs[int(r.integers(len(docs)))]
            at = int(r.integers(max(1, len(doc) - stretch + 1)))
            piece = doc[at:at + stretch]
            words += piece
            labels += [lang] * len(piece)
            if r.random() < 0.3:
                lang = int(r.integers(k))
        seq.append(np.array([vocab.setdefault(w, len(vocab)) for w in words]))
        tags.append(np.array(labels))
    feats = np.concatenate([word_features(list(vocab)[i:i + 10_000], lexicon) for i in range(0, len(vocab), 10_000)])
    size = BUCKETS + k
    met = np.zeros((size, k), bool)
    for words, labels in zip(seq, tags, strict=True):
        met[feats[words], labels[:, None]] = True
    weights, transition = np.zeros((size, k)), np.zeros((k, k))
    g2, t2 = np.full((size, k), 1e-2), np.full((k, k), 1e-2)
    for _ in range(epochs):
        order = r.permutation(len(seq))
        for i in range(0, len(order), batch):
            some = order[i:i + batch]
            idx, gold = np.concatenate([seq[s] for s in some]), np.concatenate([tags[s] for s in some])
            lengths = np.array([len(seq[s]) for s in some])
            f = feats[idx]
            e = weights[f].sum(axis=1)
            m = marginals(e, lengths, transition)
            d = m.copy()
            d[np.arange(len(gold)), gold] -= 1
            d /= len(some)
            flat = f.ravel()
            g = np.stack([np.bincount(flat, np.repeat(d[:, j], f.shape[1]), minlength=size) for j in range(k)], axis=1)
            g += 1e-5 * weights
            g[0] = 0
            # pair marginals: p(i, j) = m_i of the word before, carried by the transition to the word after
            inner = np.ones(len(gold), bool)
            inner[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = False
            at = np.flatnonzero(inner)
            pair = _pairs(e, m, lengths, transition, at)
            gt = pair.sum(axis=0) / len(some)
            np.add.at(gt, (gold[at - 1], gold[at]), -1 / len(some))
            g2 += g ** 2
            t2 += gt ** 2
            weights -= rate * g / np.sqrt(g2)
            transition -= rate * gt / np.sqrt(t2)
    return Model(langs, weights.astype(np.float32), transition, lexicon, met)


def _pairs(e: np.ndarray, m: np.ndarray, lengths: np.ndarray, transition: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marginals of (label before, label here) at words ``at``.

    In a chain p(here | before) is proportional to t(before, here) psi(here) beta(here);
    beta follows from m(here) and the forward part, so the pair is rebuilt from the
    forward vectors alone: p(before | here) is proportional to alpha(before) t(before, here).
    """
    k = e.shape[1]
    t = np.exp(transition - transition.max())
    psi = np.exp(e - e.max(axis=1, keepdims=True))
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alpha, v = np.empty_like(psi), np.ones((len(lengths), k))
    for s in range(int(lengths.max())):
        live = np.flatnonzero(lengths > s)
        v = v.copy()
        new = (v[live] @ t) * psi[begin[live] + s]
        v[live] = new / new.max(axis=1, keepdims=True)
        alpha[begin[live] + s] = v[live]
    back = alpha[at - 1][:, :, None] * t[None]
    back /= back.sum(axis=1, keepdims=True)
    return back * m[at][:, None, :]


def sample(known: DataFrame, per_lang: int) -> DataFrame:
    """The first ``per_lang`` ids of each language in hash order; a language is ranked
    in 64 parts first, so the last ranking sees 64 * ``per_lang`` of its rows at most."""
    order = [F.xxhash64("doc_id", F.lit(3)), F.col("doc_id")]
    ids = known.distinct()
    for key in (["lang", F.pmod(F.xxhash64("doc_id"), F.lit(64))], ["lang"]):
        first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        ids = ids.withColumn("__n", first).where(F.col("__n") <= per_lang).drop("__n")
    return ids


def learn(docs: DataFrame, per_lang: int = 300, longest: int = 100_000) -> Model:
    """A model from documents with a language outside the held-out fifth."""
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder(5) != 0)))
    ids = materialize(sample(known, per_lang), name="lang-sample")  # per_lang rows a language at most
    # one row per sampled id, whatever rows repeat it: its smallest text
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
            .join(F.broadcast(ids), ["doc_id", "lang"]).where(F.length("text") <= longest)
            .groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
            .orderBy("lang", F.xxhash64("doc_id", F.lit(3)), "doc_id").collect())
    return fit([(r["lang"], r["text"]) for r in rows])


SPAN = pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())])


def predict(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score and, if asked for, the runs of words by language."""
    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
    schema = pa.schema(fields + [("spans", pa.list_(SPAN))] * spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_model(model)
        for batch in batches:
            for some in slices(batch, batch.column("text")):
                labels = own.label(some.column("text").to_pylist(), spans)
                yield rows_batch([(d, h, *x) for d, h, x in zip(some.column("doc_id").to_pylist(), some.column("held_out").to_pylist(), labels, strict=True)], schema)

    held = F.coalesce(remainder(5) == 0, F.lit(False))
    ddl = "doc_id long, held_out boolean, lang_pred string, score double" + ", spans array<struct<lang:string,first:long,last:long>>" * spans
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text").mapInArrow(run, ddl)


def slices(batch: pa.RecordBatch, texts: pa.Array, size: int = 1_000_000, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text and at most ``rows`` rows each, one row at least."""
    lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
    a, held = 0, 0
    for i, n in enumerate(lengths):
        held += n
        if held >= size or i + 1 - a == rows:
            yield batch.slice(a, i + 1 - a)
            a, held = i + 1, 0
    if a < batch.num_rows:
        yield batch.slice(a)


def worker_model(model: Model) -> Model:
    """The model a Python worker already has, with its cache of words, if it is the same."""
    key = hash((tuple(model.langs), model.weights.tobytes(), model.transition.tobytes(), model.met.tobytes()))
    return worker_tables(("langid", key), lambda: model)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.8) -> DataFrame:
    """The documents in whose words the field identifies languages it has met, with their own columns.

    Every document is labelled by the field, word by word. It stays if it has a language and
    at least ``least`` of its features (n-grams, affixes, words) occurred in the fit in
    the languages that its words get: code-switched texts of known languages stay; other
    languages and scripts, and chance letters, go, as their features are met in one language or
    another, but not together in the one of the words around them. Documents without a letter go too.
    """
    text = place(docs.columns, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_model(model)
        for batch in batches:
            for some in slices(batch, batch.column(0).field(text)):
                row = some.column(0)
                langs, evidence = own.identify(row.field(text).to_pylist())
                yield pa.RecordBatch.from_struct_array(row.filter(pa.array((np.array(langs) != "und") & (evidence >= least))))

    return docs.select(F.struct("*").alias("__row")).mapInArrow(run, docs.schema)
