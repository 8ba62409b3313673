"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, divergence, langid, licenses, mixing, neardup, packing, quality, rules, sharding, tokenids, topk, urls
from .common import documents


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(documents(spark, sf_dir), words=4).drop("t")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), 40)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, sf_dir))
    return found.withColumn("n_notices", F.size("matches").cast("long")).drop("matches")


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.predict(docs, langid.learn(docs))


def op11_tokenids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.read_ids(tokenids.write_ids(documents(spark, sf_dir)))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_quality, op3_neardup, op4_topk, op5_sharding, op6_mixing, op7_rules,
                            op8_licenses, op9_urls, op10_langid, op11_tokenids, op12_divergence,
                            op13_alignment)}

ORACLES = {
    "op4_topk": """
WITH rows AS (
  SELECT DISTINCT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(COALESCE(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]), 0) AS BIGINT) AS score
  FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
""",
    "op12_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, COALESCE(text, '') AS text, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source
  FROM documents),
w AS (
  SELECT r, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
c AS (
  SELECT r, lang, source, term, count(*) AS n FROM w GROUP BY r, lang, source, term),
kept AS (
  SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY lang, term HAVING count(*) >= 3),
size AS (
  SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
own AS (
  SELECT c.lang, c.source, c.term, CAST(sum(c.n) AS BIGINT) AS n
  FROM c JOIN kept ON c.lang = kept.lang AND c.term = kept.term GROUP BY c.lang, c.source, c.term),
total AS (
  SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM own GROUP BY lang, source),
grp AS (
  SELECT g.lang, g.source, COALESCE(t.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN total t ON g.lang = t.lang AND g.source = t.source),
share AS (
  SELECT g.lang, g.source, k.term, COALESCE(o.n, 0) AS n,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (COALESCE(o.n, 0) + 1)) // (g.total + s.v) AS BIGINT) AS p,
         CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.n + 1)) // (s.total + s.v) AS BIGINT) AS q
  FROM grp g JOIN size s ON g.lang = s.lang JOIN kept k ON g.lang = k.lang
  LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source AND k.term = o.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS BIGINT) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(p.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item
  UNION ALL
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM share WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item COLLATE "C") AS k FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR k <= 200
""",
    "op6_mixing": r"""
WITH d AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('29|' || COALESCE(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(COALESCE(text, ''))) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1 AS k FROM s),
x AS (
  SELECT *, CAST([3.0, 1.0, 2.0][k % 3 + 1] AS DOUBLE) AS weight FROM w),
f AS (
  SELECT *, source_size * 2.0 / weight AS filled FROM x),
l AS (
  SELECT *, (1.5 * sum(source_size) OVER () - 2.0 * COALESCE(sum(source_size) OVER before, 0))
            / (sum(weight) OVER () - COALESCE(sum(weight) OVER before, 0)) AS level
  FROM f WINDOW before AS (ORDER BY filled, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, weight,
         CAST(least(source_size * 2.0, (SELECT level FROM l WHERE level < filled ORDER BY filled, k LIMIT 1) * weight) AS DOUBLE) AS target
  FROM l),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0) ELSE 0.0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.source_size, COALESCE(r.target, r.source_size * 2.0) AS target,
       CAST(d.size * (floor(r.rate) + CASE WHEN CAST('0x' || substr(d.h, 1, 13) AS BIGINT) / 4503599627370496.0 < r.rate - floor(r.rate)
                                           THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""",
}
