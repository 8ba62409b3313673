"""Slowly changing dimensions: version chaining (W7) and latest snapshots."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import HOT_ROWS, time_buckets

DEFAULT_BUCKET = _dt.timedelta(days=1)


def _ls(v) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def build_scd2(changes: DataFrame, key, at: str, attrs: Sequence[str],
               order_by: Sequence[str] = (), bucket: _dt.timedelta = DEFAULT_BUCKET,
               valid_from: str = "valid_from", valid_to: str = "valid_to",
               current: str = "is_current", hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Chain a change log into versions: ``valid_to`` is the next change's time.

    Each change opens a version ``[at, next at)``; the last one per key is open
    (``valid_to`` NULL, ``is_current`` 1). Changes at equal times are ordered by
    ``order_by`` (give a unique column for a deterministic chain); such a pair
    yields a zero-length version, which interval lookups never match.

    Plan: ``lead`` within (key, time bucket) groups, so one key with a huge
    history is cut into many tasks (a bucket of more than ``hot_rows`` changes at
    quantiles of its times, ``operators.buckets``); the last change of a bucket takes the first
    change of the next non-empty bucket, found on a per-(key, bucket) aggregate
    (one row per bucket) with a second, tiny window.
    """
    keys = _ls(key)
    rows = changes.select(*keys, at, *[c for c in order_by if c not in keys and c != at],
                          *[a for a in attrs if a not in keys and a != at and a not in order_by])
    j = next_time(rows, keys, at, order_by, bucket, hot_rows)
    vt = F.col("__next")
    return j.select(*keys, *[a for a in attrs if a not in keys], F.col(at).alias(valid_from),
                    vt.alias(valid_to), vt.isNull().cast("bigint").alias(current))


def next_time(df: DataFrame, key, at: str, order_by: Sequence[str] = (),
              bucket: _dt.timedelta = DEFAULT_BUCKET, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """``df`` (rows with a key and a time) plus ``__next``: the time of the next
    row of the same key in (time, ``order_by``) order, NULL for the last.

    ``lead`` runs within (key, time bucket) groups; the last row of a bucket
    takes the first time of the next non-empty bucket, from a one-row-per-bucket
    aggregate and a small window over buckets, so a key with a huge history is
    spread over many tasks.
    """
    keys = _ls(key)
    ob = [F.col(c) for c in order_by]
    rows = df.where(F.col(at).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    rows = time_buckets(rows, keys, at, bucket, hot_rows)
    w = Window.partitionBy(*keys, "__b").orderBy(F.col(at), *ob)
    inner = rows.withColumn("__next_in", F.lead(at).over(w))
    firsts = rows.groupBy(*keys, "__b").agg(F.min(at).alias("__first"))
    wb = Window.partitionBy(*keys).orderBy("__b")
    nxt = firsts.select(*keys, "__b", F.lead("__first").over(wb).alias("__nbf"))
    j = inner.join(nxt, on=[*keys, "__b"], how="left")
    return j.withColumn("__next", F.coalesce(F.col("__next_in"), F.col("__nbf"))).drop("__next_in", "__nbf", "__b")


def latest_snapshot(df: DataFrame, key, time: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Latest row per key by ``time`` (ties broken by ``order_by``, then by the
    remaining columns, so the pick is deterministic).

    ``max`` of a struct is a plain aggregate with map-side partial aggregation:
    a hot key shrinks to one row per map task before the shuffle.
    """
    keys = _ls(key)
    rest = [c for c in df.columns if c not in keys and c != time and c not in order_by]
    m = F.max(F.struct(F.col(time).alias(time), *[F.col(c) for c in order_by],
                       *[F.col(c) for c in rest])).alias("__m")
    present = F.col(time).isNotNull()
    for k in keys:  # a row without its key belongs to no entity
        present = present & F.col(k).isNotNull()
    out = df.where(present).groupBy(*keys).agg(m)
    return out.select(*keys, *[F.col(f"__m.{c}").alias(c) for c in [time, *order_by, *rest]])
