"""Weighted rendezvous hashing of stable record keys over shards.

Every shard draws a uniform number u of 52 bits from the MD5 of (seed, shard, key)
and scores -weight / ln(u); the record goes to the highest score. A shard's scores do not
depend on the others, so one more shard takes rows only into itself, and a
changed weight moves only the rows it must.

Scale: choosing a shard is a narrow expression (no shuffle). For slots, equal
rows are first counted together, map-side; a count above CHUNK becomes several rows
of at most CHUNK copies each. These are spread over (shard, bucket) groups by
a hash that takes in the chunk, with buckets enough for BUCKET_ROWS copies each, so
equal rows that hold a third of the table are written by many tasks. Rows are ranked
inside a bucket, and shifted by the buckets before it.

Defined results: a null key is hashed as its own constant; equal keys share a
shard; a null text has size 16 and the CRC-32 of an empty text; an empty table
yields no rows; repeated rows get slots of their own, neighbouring within a chunk; very
long texts count by their bytes and are never copied; extra columns are ignored.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_text, join_small, materialize

#: Rows of one (shard, bucket) group that a task writes, on average.
BUCKET_ROWS = 50_000
#: Copies of equal rows that one row of the ranking stands for, at most.
CHUNK = 4096


def _weights(shards: int, weights: Sequence[float] | None) -> list[float]:
    weights = [1.0] * shards if weights is None else list(weights)
    if shards < 1 or len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight for each of at least one shard")
    return weights


def score(key: Column, shard: int, weight: float, seed: int = 17) -> Column:
    """The shard's score for a key: -weight / ln(u)."""
    text = F.coalesce(key.cast("string"), F.lit("\0null"))
    hexed = F.md5(F.concat(F.lit(f"{seed}|{shard}|"), text).cast("binary"))
    u = (F.conv(F.substring(hexed, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(2.0 ** 52)  # never 0 or 1
    return -F.lit(float(weight)) / F.log(u)


def _winner(key: Column, shards: int, weights: Sequence[float], seed: int) -> Column:
    """struct(s: the highest score, i: minus its shard); a tie goes to the smaller shard."""
    each = [F.struct(score(key, i, weights[i], seed).alias("s"), F.lit(-i).alias("i")) for i in range(shards)]
    return each[0] if shards == 1 else F.greatest(*each)


def rendezvous(key: Column, shards: int, weights: Sequence[float] | None = None, seed: int = 17) -> Column:
    """The shard of a key among 0 .. shards - 1, each with a positive weight (1 where none is given)."""
    return -_winner(key, shards, _weights(shards, weights), seed)["i"]


def assign(df: DataFrame, key: str, shards: int, weights: Sequence[float] | None = None, name: str = "shard") -> DataFrame:
    return df.withColumn(name, rendezvous(F.col(key), shards, weights).cast("int"))


def with_slots(df: DataFrame, shard: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """Gapless slots from 0 inside each shard; ``df`` must hold just what makes rows equal."""
    cols = df.columns
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__all"))
    counted = counted.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__all") - 1, F.lit(CHUNK).cast("long"))))
    counted = materialize(counted.withColumn("__n", F.least(F.col("__all") - F.col("__at"), F.lit(CHUNK))).drop("__all"), name="shard-rows")
    size = counted.agg(F.count_distinct(shard), F.sum("__n")).first()
    buckets = max(1, -(-(size[1] or 0) // (BUCKET_ROWS * max(1, size[0]))))
    counted = counted.withColumn("__b", F.pmod(F.xxhash64(*order, "__at", F.lit(5)), F.lit(buckets)))
    sums = counted.groupBy(F.col(shard).alias("__s"), F.col("__b").alias("__c")).agg(F.sum("__n").alias("__m"))
    before = Window.partitionBy("__s").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums.select("__s", "__c", F.coalesce(F.sum("__m").over(before), F.lit(0)).alias("__o")), name="shard-offsets")
    inside = Window.partitionBy(shard, "__b").orderBy(*[F.col(c) for c in (*order, "__at")]).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("__p", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    placed = join_small(ranked, sums, (F.col(shard) == F.col("__s")) & (F.col("__b") == F.col("__c")), "inner")
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))  # CHUNK of them at most
    return (placed.select(*cols, "__o", "__p", copy.alias("__i"))
            .select(*cols, (F.col("__o") + F.col("__p") + F.col("__i")).alias(slot)))


def shard_documents(docs: DataFrame, shards: int = 40, weights: Sequence[float] | None = None,
                    new_weight: float = 1.0) -> DataFrame:
    """Shard, slot and the shard with one more, per document, keyed by ``doc_id``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       crc_text(text).alias("text_crc32"))
    key, seed = F.col("doc_id"), 17
    rows = rows.withColumn("__w", _winner(key, shards, _weights(shards, weights), seed))
    # a new shard takes a row where its score beats the old ones'; all else stays
    moves = score(key, shards, _weights(1, [new_weight])[0], seed) > F.col("__w.s")
    rows = rows.select("doc_id", "size", "text_crc32", (-F.col("__w.i")).cast("int").alias("shard"),
                       F.when(moves, F.lit(shards)).otherwise(-F.col("__w.i")).cast("int").alias("grown_shard"))
    return with_slots(rows, "shard", ["doc_id", "size", "text_crc32"]).withColumn("law", F.lit("key"))


def write_shards(df: DataFrame, path: str, key: str, shards: int, weights: Sequence[float] | None = None,
                 files: int = 1) -> None:
    """Write whole records below ``shard=<i>/``, each shard in ``files`` parts split by a salt."""
    out = assign(df, key, shards, weights, "shard")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()), F.lit(files))
    out.repartition(shards * files, "shard", salt).write.partitionBy("shard").parquet(path)
