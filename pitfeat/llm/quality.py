"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of 64 words. Each passage becomes a vector:
hashed byte pairs and a few shares (capitals, digits, symbols, distinct words,
repeated neighbours, word pairs seen before). An encoder h = tanh(W x + b) is
pooled by gated attention, a = softmax(w . (tanh(V h) * sigmoid(U h))), and the
label's probability is sigmoid(c . sum(a h) + d). All parts are learned together
from document labels.

The fit uses a bounded sample: at most ``per_class`` labelled documents a class,
chosen by a hash of their id, of at most ``longest`` characters; it runs on the
driver in numpy and is the same at every run. Losses are weighted so that classes
count as they do among all labels. Scoring covers whole texts.

Scale: the sample's ids come from the labels alone; its texts by a join that
broadcasts these bounded ids. Scoring is one narrow pass; a task holds one Arrow
batch and the vectors of about a million bytes of text. A longer document is
encoded in segments and pooled as one bag.

Defined results: null and empty texts are one empty passage and get its score; a
null doc_id is never learned from and is not held out; of contradicting labels
for one id the lowest counts; with labels of one class only (or none) every score
is that class (0.5, hence predicted 1); an empty table yields no rows; repeated
rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BYTES, crc_text, materialize, place, rows_batch

PASSAGE = 64
PAIRS = 256
SHARES = 12
SEGMENT = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_KIND = np.zeros(256, np.int64)  # 0 letter or other, 1 capital, 2 digit, 3 symbol, 4 non-ASCII
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[48:58], _KIND[65:91], _KIND[128:] = 2, 1, 4
_BUCKET = np.random.default_rng(3).integers(0, PAIRS, 65536)
_POWER = (np.uint64(0x9E3779B97F4A7C15) ** np.arange(64, dtype=np.uint64)) | np.uint64(1)


def _runs_seen(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether an equal value stood earlier in its group."""
    order = np.lexsort((value, group))  # stable
    g, v = group[order], value[order]
    out = np.zeros(len(value), bool)
    out[order[1:]] = (g[1:] == g[:-1]) & (v[1:] == v[:-1])
    return out


def passages(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages of the texts, and the number of passages of each text."""
    raw = np.frombuffer(b"\n".join(units) + b"\n", np.uint8)
    begin = np.cumsum([0] + [len(u) + 1 for u in units])
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    unit = np.searchsorted(begin, starts, "right") - 1
    n_words = np.bincount(unit, minlength=len(units))
    counts = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(counts)])
    total = first[-1]
    x = np.zeros((total, PAIRS + SHARES), np.float32)
    if not len(starts):
        return x, counts
    position = np.arange(len(starts)) - np.concatenate([[0], np.cumsum(n_words)])[unit]
    passage = first[unit] + position // PASSAGE  # of each word

    at = np.flatnonzero(~space)
    word = np.cumsum(np.isin(at, starts, assume_unique=True)) - 1
    of = passage[word]
    cur = raw[at].astype(np.int64)
    before = np.where(at > 0, raw[at - 1], 10).astype(np.int64)
    before[_SPACE[before]] = 32
    pairs = np.bincount(of * PAIRS + _BUCKET[before * 256 + cur], minlength=total * PAIRS).reshape(total, PAIRS)
    n_bytes = np.bincount(of, minlength=total).clip(1)
    x[:, :PAIRS] = np.sqrt(pairs / n_bytes[:, None])

    weighted = (cur.astype(np.uint64) + np.uint64(1)) * _POWER[(at - starts[word]) & 63]
    begins = np.searchsorted(at, starts)
    h = np.add.reduceat(weighted, begins)
    length = np.diff(np.append(begins, len(at)))
    words = np.bincount(passage, minlength=total).clip(1)
    share = lambda flag: np.bincount(passage, weights=flag, minlength=total) / words
    kinds = np.bincount(of * 5 + _KIND[cur], minlength=total * 5).reshape(total, 5) / n_bytes[:, None]
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (unit[1:] == unit[:-1])
    pair = np.concatenate([[np.uint64(0)], h[:-1]]) * np.uint64(0xD6E8FEB86659FD93) ^ h
    last = raw[np.append(starts[1:], len(raw)) - 1]
    ends = raw[at[np.append(begins[1:], len(at)) - 1]]
    x[:, PAIRS:] = np.stack([kinds[:, 1], kinds[:, 2], kinds[:, 3], kinds[:, 4], share(length) / 10, share(length == 1),
                             share(same), share(_runs_seen(passage, h)), share(_runs_seen(unit, pair)),
                             share(_KIND[ends] == 3), share(last == 10), np.log1p(words) / 5], axis=1)
    return x, counts


def segments(text: str | None) -> list[bytes]:
    """The text's bytes, cut at white space into parts of about SEGMENT bytes."""
    raw, out, at = (text or "").encode(), [], 0
    while len(raw) - at > SEGMENT:
        cut = max(raw.rfind(b" ", at + 1, at + SEGMENT), raw.rfind(b"\n", at + 1, at + SEGMENT))
        cut = at + SEGMENT if cut <= at else cut
        out.append(raw[at:cut])
        at = cut
    return [*out, raw[at:]]


def bags(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passage vectors, number of the text each belongs to), about SEGMENT bytes at a time."""
    units, of, held = [], [], 0
    for i, text in enumerate(texts):
        for part in segments(text):
            units.append(part)
            of.append(i)
            held += len(part)
            if held >= SEGMENT:
                x, counts = passages(units)
                yield x, np.repeat(of, counts)
                units, of, held = [], [], 0
    if units:
        x, counts = passages(units)
        yield x, np.repeat(of, counts)


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised inputs, at most 8 deviations from the mean."""
    return np.clip((x - mean) / scale, -8, 8)


@dataclass
class Model:
    """Weights of encoder (W, b), gated attention (V, U, w) and head (c, d); inputs are standardised."""
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray]
    constant: float | None = None

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.tanh(standard(x, self.mean, self.scale) @ self.p["W"] + self.p["b"])
        gate = np.tanh(h @ self.p["V"]) / (1 + np.exp(-(h @ self.p["U"])))
        return h, gate @ self.p["w"]

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        parts = [(*self.encode(x), of) for x, of in bags(texts)]
        h, logit, of = (np.concatenate(c) for c in zip(*parts, strict=True))
        most = np.full(len(texts), -np.inf)
        np.maximum.at(most, of, logit)
        a = np.exp(logit - most[of])
        a /= np.bincount(of, weights=a, minlength=len(texts))[of]
        y = np.bincount(of, weights=a * (h @ self.p["c"]), minlength=len(texts)) + self.p["d"]
        return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def gradient(p: dict[str, np.ndarray], z: np.ndarray, start: np.ndarray, bag: np.ndarray, labels: np.ndarray,
             weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted mean log loss of bags of passages ``z`` (bag of each, first of each bag) and its gradient."""
    h = np.tanh(z @ p["W"] + p["b"])
    tv, su = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
    logit = (tv * su) @ p["w"]
    a = np.exp(logit - np.maximum.reduceat(logit, start)[bag])
    a /= np.add.reduceat(a, start)[bag]
    pooled = np.add.reduceat(a[:, None] * h, start)
    y = 1 / (1 + np.exp(-np.clip(pooled @ p["c"] + p["d"], -30, 30)))
    loss = float(-(weights * (labels * np.log(y) + (1 - labels) * np.log(1 - y))).mean())
    dy = (y - labels) * weights / len(labels)
    g = {"c": pooled.T @ dy, "d": dy.sum()}
    dpool = dy[:, None] * p["c"]
    da = (h * dpool[bag]).sum(axis=1)
    dlogit = a * (da - np.add.reduceat(a * da, start)[bag])
    g["w"] = (tv * su).T @ dlogit
    dg = dlogit[:, None] * p["w"]
    dtv, dsu = dg * su * (1 - tv ** 2), dg * tv * su * (1 - su)
    g["V"], g["U"] = h.T @ dtv, h.T @ dsu
    dh = (a[:, None] * dpool[bag] + dtv @ p["V"].T + dsu @ p["U"].T) * (1 - h ** 2)
    g["W"], g["b"] = z.T @ dh, dh.sum(axis=0)
    return loss, g


def fit(texts: list[str | None], labels: np.ndarray, weights: np.ndarray, hidden: int = 24, gates: int = 12,
        epochs: int = 25, batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Model:
    """Adam on the weighted log loss; gradients through head, attention and encoder."""
    parts = list(bags(texts))
    x, of = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    x = standard(x, mean, scale).astype(np.float64)
    r = np.random.default_rng(seed)
    p = {"W": r.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), "b": np.zeros(hidden), "V": r.normal(0, hidden ** -0.5, (hidden, gates)),
         "U": r.normal(0, hidden ** -0.5, (hidden, gates)), "w": r.normal(0, gates ** -0.5, gates), "c": r.normal(0, hidden ** -0.5, hidden), "d": np.zeros(())}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    bounds = np.searchsorted(of, np.arange(len(texts) + 1))
    for _ in range(epochs):
        shuffled = r.permutation(len(texts))
        for i in range(0, len(shuffled), batch):
            docs = shuffled[i:i + batch]
            rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            start = np.concatenate([[0], np.cumsum(bounds[docs + 1] - bounds[docs])[:-1]])
            bag = np.repeat(np.arange(len(docs)), bounds[docs + 1] - bounds[docs])
            _, g = gradient(p, x[rows], start, bag, labels[docs], weights[docs])
            g["W"] = g["W"] + decay * p["W"]
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, p)


def remainder(mod: int) -> Column:
    return F.pmod(crc_text(F.col("doc_id").cast("string")), F.lit(mod))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 200_000) -> Model:
    """A model from labelled documents outside the held-out third."""
    spark = docs.sparkSession
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder(3) != 1))
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    known = materialize(known, name="quality-labels")
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Model(np.zeros(1), np.ones(1), {}, float(next(iter(counts), 0.5)))
    order = [F.xxhash64("doc_id", F.lit(11)), F.col("doc_id")]
    parts = [known.where(F.col("quality") == q).orderBy(*order).limit(per_class) for q in (0, 1)]
    ids = materialize(parts[0].union(parts[1]), name="quality-sample")  # 2 * per_class rows at most
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
            .where(F.coalesce(F.length("text"), F.lit(0)) <= longest)
            .groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))  # one row per id
            .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").collect())
    y = np.array([r["quality"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(1), np.ones(1), {}, float(y[0]) if len(y) else 0.5)
    share = counts[1] / (counts[0] + counts[1])
    weights = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    return fit([r["text"] for r in rows], y, weights)


SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                some = batch.slice(i, 256)
                p = model.score(some.column("text").to_pylist()).tolist()
                yield rows_batch(zip(some.column("doc_id").to_pylist(), some.column("held_out").to_pylist(), p, [int(s >= 0.5) for s in p], strict=True), SCHEMA)

    held = F.coalesce(remainder(3) == 1, F.lit(False))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents the model predicts to be good, with their own columns and types."""
    text = place(docs.columns, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                row = batch.column(0).slice(i, 256)
                keep = pa.array(model.score(row.field(text).to_pylist()) >= 0.5)
                yield pa.RecordBatch.from_struct_array(row.filter(keep))

    return docs.select(F.struct("*").alias("__row")).mapInArrow(run, docs.schema)
