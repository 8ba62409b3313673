"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Vectors become integers floor(scale * x). A block of candidates is stored as
postings: for each term (component) the candidates with a non-zero weight and
those weights. Each query is a sparse row; term by term its weight times the
postings is added into a dense array with one score per candidate. Partition
selection keeps the k best of the block (ties to smaller ids), and a window with
a group limit merges the blocks.

Scale: queries and candidates meet in cells of (query block, candidate block),
each of bounded size, so no side is broadcast or collected; a task holds one
candidate block and one query block. k rows leave a cell per query.

Defined results: rows with a null id, a null vector or a null or non-finite
component take no part; a shorter vector counts as followed by zeros; an empty
vector scores 0; a row is no candidate for a query with its own id; equal rows
(same id and vector) count once; fewer candidates than k give fewer rows; extra
columns are ignored. Scores are exact 64-bit integers; where a sum could leave
them, Python integers are used and the score is held at the 64-bit limits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SCHEMA = "query_id long, vec_id long, score long"
LIMIT = 2 ** 63 - 1


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, v): valid rows with components floor(scale * x) as doubles, which are whole numbers."""
    v = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    ok = F.forall(F.col(vec_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).where(ok)
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).distinct())


def postings(vectors: list[np.ndarray], exact: bool) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """Per term: the candidates with a weight there (None: all of them) and their weights."""
    terms = max((len(v) for v in vectors), default=0)
    m = np.zeros((terms, len(vectors)), np.int64 if exact else object)
    for i, v in enumerate(vectors):
        m[:len(v), i] = [int(x) for x in v] if not exact else v.astype(np.int64)
    out = []
    for row in m:
        at = np.flatnonzero(row)
        out.append((None, row) if len(at) == len(row) else (at, row[at]))
    return out


def accumulate(query: np.ndarray, lists: list, n: int, exact: bool) -> np.ndarray:
    """Scores of all n candidates: term after term, weight times postings."""
    scores = np.zeros(n, np.int64 if exact else object)
    for t, w in enumerate(query[:len(lists)]):
        if w:
            at, weights = lists[t]
            if at is None:
                scores += int(w) * weights
            elif len(at):
                scores[at] += int(w) * weights
    return scores if exact else np.array([max(-LIMIT - 1, min(LIMIT, s)) for s in scores], np.int64)


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller position."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])


def cell(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    candidates = candidates.sort_values("vec_id")
    ids, vectors = candidates["vec_id"].to_numpy(np.int64), [np.asarray(v, float) for v in candidates["v"]]
    rows = [np.asarray(v, float) for v in queries["v"]]
    size = lambda vs: max((float(np.abs(v).sum()) for v in vs), default=0.0)
    most = max((float(np.abs(v).max()) for v in vectors if len(v)), default=0.0)
    exact = size(rows) * max(most, 1.0) < 2.0 ** 62 and most < 2.0 ** 62
    lists, out = postings(vectors, exact), []
    for q, v in zip(queries["vec_id"], rows, strict=True):
        scores = accumulate(v, lists, len(ids), exact)
        others = np.flatnonzero(ids == q)
        if len(others):  # the query's own row
            left = np.delete(np.arange(len(ids)), others)
            best = left[select(scores[left], k)]
        else:
            best = select(scores, k)
        out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": scores[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, block_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """Each query's k best candidates; both frames hold (vec_id, v) as ``integer_vectors`` makes them."""
    spark = candidates.sparkSession
    q, c = materialize(queries, name="topk-queries"), materialize(candidates, name="topk-candidates")
    least = spark.sparkContext.defaultParallelism  # blocks for all cores, on small inputs
    n_q, n_c = max(1, -(-q.count() // query_rows)), max(least, -(-c.count() // block_rows))
    q = q.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(n_q)))
    c = c.withColumn("cb", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(n_c)))
    q = q.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
    c = c.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))))
    run = lambda a, b: cell(a, b, k)
    best = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(run, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def search(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """Rows whose id is divisible by ``every`` against all rows."""
    rows = integer_vectors(embeddings, "vec_id", "embedding", scale)
    return top_k(rows.where(F.col("vec_id") % every == 0), rows, k)
