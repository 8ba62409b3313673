"""Published tables that lose keys: snapshot differences as a change feed.

``publish_latest`` only ever adds rows. Here a table is published as a whole, time
after time, and only what differs from the last state is written: upserts, and
tombstones for keys that are gone, under a change number. The folder of changes is
the feed: a stream or a replica reads the numbers after the one it has; the
present table is the last change of every key, tombstones left out. A
publication that is run again under its number starts from the state before that
number and rewrites its own partition, so a retry changes nothing.

Scale: a publication is one full outer join of the new table with the last state
on its key and a write of the differences; keys with a NULL part belong to no
entity and are not published. Nothing is collected but the greatest change number.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NUMBER, KIND = "change_number", "change"
UPSERT, DELETE = "upsert", "delete"


def _ls(v) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def snapshot_changes(old: DataFrame, new: DataFrame, key) -> DataFrame:
    """``new``'s columns and ``change``: rows that ``old`` lacks or has otherwise, and keys that only ``old`` has.

    Keys are unique on both sides; a deleted row keeps its key alone.
    """
    keys = _ls(key)
    rest = [c for c in new.columns if c not in keys]
    whole = lambda df: df.where(_all_set(keys)).select(*[F.col(f"`{k}`") for k in keys], F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("none")]).alias("__row"))
    a, b = whole(old.select(*new.columns)).alias("a"), whole(new).alias("b")
    same = None
    for k in keys:
        one = F.col(f"a.{k}") == F.col(f"b.{k}")
        same = one if same is None else same & one
    j = a.join(b, same, "full")
    kind = F.when(F.col("b.__row").isNull(), F.lit(DELETE)).when(F.col("a.__row").isNull() | ~F.col("a.__row").eqNullSafe(F.col("b.__row")), F.lit(UPSERT))
    j = j.withColumn(KIND, kind).where(F.col(KIND).isNotNull())
    return j.select(*[F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in keys], *[F.col(f"b.__row.{c}").alias(c) for c in rest], KIND)


def _all_set(keys: Sequence[str]):
    out = None
    for k in keys:
        one = F.col(f"`{k}`").isNotNull()
        out = one if out is None else out & one
    return out


def publish_snapshot(spark: SparkSession, new: DataFrame, key, path: str, number: int) -> None:
    """Write the changes from the state before ``number`` to ``new`` as that change number (a long, ascending).

    The first publication under ``path`` has number 0.
    """
    old = read_snapshot(spark, path, key, new.schema, before=number) if number else new.limit(0)
    snapshot_changes(old, new, key).write.mode("overwrite").parquet(f"{path}/{NUMBER}={int(number)}")


def read_changes(spark: SparkSession, path: str, after: int | None = None, before: int | None = None) -> DataFrame:
    """The feed: all changes with numbers above ``after`` and below ``before``."""
    rows = spark.read.parquet(path)
    if after is not None:
        rows = rows.where(F.col(NUMBER) > after)
    return rows if before is None else rows.where(F.col(NUMBER) < before)


def read_snapshot(spark: SparkSession, path: str, key, schema: StructType | None = None, before: int | None = None) -> DataFrame:
    """The published table: each key's last change (before a number), unless it was a deletion."""
    keys = _ls(key)
    rows = read_changes(spark, path, before=before)
    cols = [f.name for f in schema] if schema else [c for c in rows.columns if c not in (NUMBER, KIND)]
    rest = [c for c in cols if c not in keys]
    last = F.max(F.struct(NUMBER, KIND, *[F.col(f"`{c}`") for c in rest])).alias("__m")
    last = rows.groupBy(*keys).agg(last).where(F.col(f"__m.{KIND}") == UPSERT)
    return last.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__m.`{c}`").alias(c) for c in cols])


def apply_changes(replica: DataFrame, changes: DataFrame, key) -> DataFrame:
    """A replica of the table after the given changes: the last one of every key they name."""
    keys = _ls(key)
    rest = [c for c in replica.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max(F.struct(NUMBER, KIND, *[F.col(f"`{c}`") for c in rest])).alias("__m"))
    kept = replica.join(last.select(*keys), keys, "left_anti")
    new = last.where(F.col(f"__m.{KIND}") == UPSERT).select(*[F.col(f"`{c}`") if c in keys else F.col(f"__m.`{c}`").alias(c) for c in replica.columns])
    return kept.unionByName(new)
