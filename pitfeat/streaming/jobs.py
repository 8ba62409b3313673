"""Structured Streaming faces of the batch operators.

* ``publish_latest``: triggered, incremental publish of the latest row per key
  of a feature table (the reference's triggered online-table sync), a
  partition per micro-batch; ``read_published`` reads it and
  ``compact_published`` folds the partitions.
* ``enrich_stream`` / ``enrich_with_spec``: stream-static as-of (and exact)
  lookups for incoming requests, optionally scored with a packaged model.
* ``stream_rolling``: watermarked sliding-window aggregates per key.
* ``stream_partials``: daily mergeable partials per key (state per key-day),
  from which ``rolling.from_partials`` evaluates any windows in batch.
* ``run_updates``: aggregates in update mode, open windows included.
* ``dropped_by_watermark``: late rows counted from the query's progress.

Sinks write files below a caller-given folder, which on a cluster must be
shared storage; checkpoints make every job restartable after an executor or
driver loss.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import instant_to_ntz, ntz_to_instant
from ..operators.lookup import (DEFAULT_BROADCAST_ROWS, DEFAULT_MAX_PER_KEY, AsOfRight, _asof_chunks,
                                _asof_packed, _fits)
from ..operators.scd import latest_snapshot


def _ls(v) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


# ---------------------------------------------------------------------------
# Keyed latest-row publish
# ---------------------------------------------------------------------------
BATCH = "publish_batch"


def _write_batches(path: str, reduce=None):
    """A foreachBatch sink: one partition folder per micro-batch, rewritten when the batch is retried."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (reduce(batch) if reduce else batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
    return write


def publish_latest(stream: DataFrame, key, time: str | None, path: str, checkpoint: str,
                   order_by: Sequence[str] = (), available_now: bool = True,
                   processing_time: str | None = None) -> StreamingQuery:
    """Keep, under ``path``, the latest row per key of ``stream``.

    Each micro-batch writes its own latest row per key to a partition named by
    the batch id, so it costs O(its rows), and a retried batch rewrites the same
    partition. ``read_published`` takes the latest row per key over all
    partitions: by ``time``, then ``order_by``, so an older row never wins.
    Without ``time`` (a type-1 table) the row published last wins.
    """
    keys = _ls(key)

    def reduce(batch: DataFrame) -> DataFrame:
        if time:
            return latest_snapshot(batch, keys, time, order_by)
        return latest_snapshot(batch.withColumn(BATCH, F.lit(0)), keys, BATCH, order_by).drop(BATCH)

    w = stream.writeStream.foreachBatch(_write_batches(path, reduce)).option("checkpointLocation", checkpoint)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_published(spark: SparkSession, path: str, key, time: str | None = None,
                   order_by: Sequence[str] = ()) -> DataFrame:
    """Latest row per key over all published partitions (see ``publish_latest``)."""
    rows = spark.read.parquet(path)
    if time:
        return latest_snapshot(rows.drop(BATCH), key, time, order_by)
    return latest_snapshot(rows, key, BATCH, order_by).drop(BATCH)


def compact_published(spark: SparkSession, path: str, into: str, key, time: str | None = None,
                      order_by: Sequence[str] = ()) -> None:
    """Fold the partitions under ``path`` into one under ``into``: an ordinary batch job.

    Run it while the publish job is stopped, then start that job again with
    ``into`` and the same checkpoint: its next batches have greater ids.
    """
    last = spark.read.parquet(path).agg(F.max(BATCH)).first()[0]
    read_published(spark, path, key, time, order_by).write.mode("overwrite").parquet(f"{into}/{BATCH}={last}")


def run_updates(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Run a streaming aggregate over all available input in update mode, then stop.

    Every group touched by a micro-batch is written as it then stands, open
    windows included; ``read_published(.., key=<the grouping columns>)`` takes
    each group's last state.
    """
    q = (df.writeStream.foreachBatch(_write_batches(path)).option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# ---------------------------------------------------------------------------
# R2: request enrichment
# ---------------------------------------------------------------------------
def enrich_stream(stream: DataFrame, rights: Sequence[AsOfRight], lookup_key, time: str,
                  broadcast: bool | str = False) -> DataFrame:
    """As-of features for each streamed request, from static tables.

    Each static table is reduced to its latest row per (key, time) and cut into
    chunks of bounded length per key; a request finds its chunk in a directory of
    first times and picks the latest row at or before its time there: two
    equi joins, no array over a key's whole history (``lookup._asof_chunks``). One
    packed array per key is broadcast instead (the stream is then never
    shuffled) only where the caller asks for it with ``broadcast="auto"`` and the
    table passes the size check (at most 2 M rows and 1,000 per key, a job).
    """
    lk = _ls(lookup_key)
    out = stream
    for i, r in enumerate(rights):
        if broadcast and _fits(r.df, DEFAULT_BROADCAST_ROWS, r.key, DEFAULT_MAX_PER_KEY):
            out = _asof_packed(out, r, lk, time, i)
        else:
            out = _asof_chunks(out, r, lk, time, i)
    return out


def enrich_with_spec(stream: DataFrame, spec, tables, model=None) -> DataFrame:
    """Apply a whole ``FeatureSpec`` to a request stream: exact lookups become
    stream-static LEFT joins, as-of lookups the chunked plan of
    ``enrich_stream``, functions Column expressions; features
    the request already carries are kept (override). With ``model`` (a
    ``plans.client.PackagedModel``) each request is also scored in the stream."""
    from ..plans.training import apply_spec
    out = apply_spec(spec, stream, tables, override=True, asof_strategy="packed")
    if model is not None:
        from ..plans.ml import score_supplied
        out = score_supplied(out, model.model, model.inputs)
    return out


# ---------------------------------------------------------------------------
# Windowed aggregates on a stream
# ---------------------------------------------------------------------------
def stream_rolling(stream: DataFrame, key, time: str, value: str, duration: str = "7 days",
                   slide: str = "1 day", watermark: str = "1 day") -> DataFrame:
    """Sliding-window SUM and COUNT of ``value`` per key, for append or update output.

    Watermarks need a TIMESTAMP: a wall-clock (TIMESTAMP_NTZ) event time is
    read as UTC, independent of the session time zone, and window bounds come
    back as UTC wall clocks. In append output a window is emitted once the
    watermark (latest event time minus ``watermark``) passes its end, in update
    output (``run_updates``) whenever it changes; rows later than the
    watermark are dropped and show up in the query's progress as
    ``numRowsDroppedByWatermark``.
    """
    keys = _ls(key)
    ntz = dict(stream.dtypes).get(time) == "timestamp_ntz"
    et = ntz_to_instant(time) if ntz else F.col(time).cast("timestamp")
    s = stream.withColumn("__et", et).withWatermark("__et", watermark)
    agg = s.groupBy(*keys, F.window("__et", duration, slide).alias("__w")).agg(
        F.sum(value).cast("double").alias(f"{value}_sum"),
        F.count(value).alias(f"{value}_count"))
    back = instant_to_ntz if ntz else (lambda c: c)
    return agg.select(*keys, back(F.col("__w.start")).alias("window_start"),
                      back(F.col("__w.end")).alias("window_end"),
                      f"{value}_sum", f"{value}_count")


def stream_partials(stream: DataFrame, spec, watermark: str = "1 day") -> tuple[DataFrame, dict]:
    """Daily (granule) mergeable partials of ``spec`` over a stream, for append or update output.

    State is one row per (key, granule) instead of one per (key, sliding
    window); append output emits a granule once the watermark passes its end,
    update output (``run_updates``) whenever it changes. The
    output (keys, ``__g``, partial columns) feeds ``rolling.from_partials``,
    which evaluates any windows over it in batch. Decimal sources of precision
    <= 18 are summed as unscaled longs (returned scales tell ``from_partials``).
    Approximate distinct counts keep one HLL sketch per (key, granule), which
    the batch side unions over each window.
    """
    from ..functions import aggregates as aggreg
    from ..operators import rolling as R

    secs = int(spec.granularity.total_seconds())
    ntz = dict(stream.dtypes).get(spec.time) == "timestamp_ntz"
    et = ntz_to_instant(spec.time) if ntz else F.col(spec.time).cast("timestamp")
    scales = R._decimal_scales(stream, spec)
    src = R._unscaled(stream, scales).withColumn("__et", et).withWatermark("__et", watermark)
    exprs = {}
    for a in spec.aggs:
        for kind, build in aggreg.get(a.fn).partials.items():
            n = aggreg.pname(kind, a.column)
            exprs.setdefault(n, build(F.col(a.column)).alias(n))
    w = F.window("__et", f"{secs} seconds")
    agg = src.groupBy(*spec.key, w.alias("__w")).agg(*exprs.values())
    g = F.floor(F.unix_seconds(F.col("__w.start")) / F.lit(secs)).cast("bigint")
    return agg.select(*spec.key, g.alias("__g"), *exprs.keys()), scales


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as later than the watermark, summed
    over the query's recent progress reports (late data is counted, not lost
    silently). For sliding windows a late event counts once per window it
    falls in. Spark judges lateness against the previous batch's watermark, so
    a late row in the batch right after the watermark moved may still be
    aggregated."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def run_to_files(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append") -> StreamingQuery:
    """Run a streaming frame over all available input into parquet files, then stop."""
    q = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(output_mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
