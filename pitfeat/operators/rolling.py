"""Windowed aggregates at observation points.

Plan (SURVEY 4.3.1, made skew-proof):

1. facts -> one row per (key, granule) of mergeable partials; spine points are
   folded into the *same* aggregation, so a single map-side-combined exchange
   on (key, granule) serves both.
2. rows are spread over (key, time bucket) groups of ``bucket_width``
   granules; a fact row is copied into the following buckets it can still
   reach (a halo of ``max_span`` granules), so every bucket evaluates its own
   points exactly. A key holding a third of all rows is cut into many buckets
   rather than landing in one task.
3. one Window node evaluates all frames (Catalyst merges the window
   expressions: one exchange, one sort), RANGE frames on the granule number,
   so no dense calendar is needed (H6).
4. spine mode re-attaches the raw spine rows with an equi-join on
   (key, granule); a hot (key, granule) on the spine side is split by AQE's
   skew join, and duplicate spine rows survive untouched.
"""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ..functions import aggregates as aggreg
from ..functions.scalar import granule, granule_start
from ..session import materialize
from ..specs import DAY as DAY_TD
from ..specs import Agg, AggregateSpec, Lookback
from .dyadic import LEVEL, distinct_count, with_blocks

G, B, PT, FT = "__g", "__b", "__pt", "__ft"


def default_bucket_width(spec: AggregateSpec) -> int:
    return max(4 * spec.max_span, 512)


def _partial_exprs(spec: AggregateSpec) -> list[Column]:
    exprs: dict[str, Column] = {}
    for a in spec.aggs:
        fn = aggreg.get(a.fn)
        for kind, build in fn.partials.items():
            n = aggreg.pname(kind, a.column)
            exprs.setdefault(n, build(F.col(a.column)).alias(n))
    return list(exprs.values())


def _source_columns(spec: AggregateSpec) -> list[str]:
    return sorted({a.column for a in spec.aggs})


def _decimal_scales(facts: DataFrame, spec: AggregateSpec) -> dict[str, int]:
    """Decimal sources (precision <= 18) every aggregate of which is scale-aware:
    they are aggregated as their unscaled long (exact; long arithmetic in the
    sliding frames) and converted back to double at the end."""
    out = {}
    types = {f.name: f.dataType for f in facts.schema.fields}
    for c in _source_columns(spec):
        t = types.get(c)
        if (isinstance(t, DecimalType) and t.precision <= 18
                and all(aggreg.get(a.fn).scaled for a in spec.aggs if a.column == c)):
            out[c] = t.scale
    return out


def _unscaled(facts: DataFrame, scales: dict[str, int]) -> DataFrame:
    return facts.withColumns({c: (F.col(c) * F.lit(10 ** s)).cast("bigint") for c, s in scales.items()}) \
        if scales else facts


def _clean_facts(facts: DataFrame, spec: AggregateSpec) -> DataFrame:
    """Facts with a key and a time: NULL keys never match a spine row."""
    cond = F.col(spec.time).isNotNull()
    for k in spec.key:
        cond = cond & F.col(k).isNotNull()
    return facts.where(cond)


def _gran(df: DataFrame, col: str, spec: AggregateSpec) -> Column:
    """Granule of ``df[col]``, read in the column's own time kind."""
    return granule(F.col(col), spec.granularity, dict(df.dtypes).get(col))


def daily_partials(facts: DataFrame, spec: AggregateSpec,
                   points: DataFrame | None = None, point_cols: Sequence[str] = ()) -> DataFrame:
    """One row per (key, granule): partial aggregates (A1), plus point flags.

    ``points`` (key columns + ``__g``) are unioned in before the aggregation so
    facts and evaluation points share one exchange. Output columns: keys,
    ``__g``, partials, ``__ft`` (row carries facts) and ``__pt`` (row is an
    evaluation point).
    """
    cols = _source_columns(spec)
    ptypes = dict(points.dtypes) if points is not None else {}
    f = _clean_facts(facts, spec).select(
        *spec.key, _gran(facts, spec.time, spec).alias(G), *cols,
        F.lit(1).alias(FT), F.lit(0 if points is not None else 1).alias(PT),
        *[F.lit(None).cast(ptypes[c]).alias(c) for c in point_cols])
    if points is not None:
        types = dict(facts.dtypes)
        p = points.select(*spec.key, G, *[F.lit(None).cast(types[c]).alias(c) for c in cols],
                          F.lit(0).alias(FT), F.lit(1).alias(PT), *point_cols)
        f = f.unionByName(p)
    return f.groupBy(*spec.key, G).agg(*_partial_exprs(spec), F.max(FT).alias(FT),
                                       F.max(PT).alias(PT), *[F.max(c).alias(c) for c in point_cols])


def _merge(a: Agg, spec: AggregateSpec, w, scales: dict[str, int]) -> Column:
    fn = aggreg.get(a.fn)
    if fn.scaled:
        return fn.merge(a.column, w, scales.get(a.column, 0))
    return fn.merge(a.column, w)


def _home(width: int) -> Column:
    return F.floor(F.col(G) / F.lit(width))


def _with_halo(rows: DataFrame, spec: AggregateSpec, width: int) -> DataFrame:
    """Assign each row its time bucket; rows carrying facts are also copied into
    the later buckets whose points they can still reach (``max_span``)."""
    reach = F.when(F.col(FT) == 1, F.floor((F.col(G) + F.lit(spec.max_span)) / F.lit(width))) \
        .otherwise(_home(width))
    return rows.withColumn(B, F.explode(F.sequence(_home(width), reach)))


#: Granules from which a window's distinct counts are unions of aligned blocks of sketches.
LONG_SKETCH = 64
#: Granules from which a window's sums and counts are differences of running values.
LONG_WINDOW = 32


def _by_blocks(a: Agg, spec: AggregateSpec) -> bool:
    lo, hi = a.window.frame(spec.granularity)
    return aggreg.get(a.fn).name == "approx_count_distinct" and hi - lo + 1 >= LONG_SKETCH


def _frame_features(spec: AggregateSpec, base, scales: dict[str, int], zone: int = 0) -> list[Column]:
    """Every aggregate as a RANGE frame over ``base``; one Window node holds them all.
    With a ``zone``, ``base`` orders blocks of sketches as ``dyadic.distinct_count`` says.

    Invertible aggregates over at least LONG_WINDOW granules are differences of two growing
    frames, which Spark keeps up row by row; others slide over their frame's rows.
    """
    feats = []
    for a in spec.aggs:
        lo, hi = a.window.frame(spec.granularity)
        fn = aggreg.get(a.fn)
        if zone and _by_blocks(a, spec):
            v = distinct_count(a.column, base, lo, hi, zone).cast(fn.result_type)
        elif fn.differ and hi - lo + 1 >= LONG_WINDOW and (a.column in scales or not fn.whole):
            upto, before = (base.rangeBetween(Window.unboundedPreceding, e) for e in (hi, lo - 1))
            v = fn.differ(a.column, upto, before, scales.get(a.column, 0)).cast(fn.result_type)
        else:
            v = _merge(a, spec, base.rangeBetween(lo, hi), scales).cast(fn.result_type)
        if a.default is not None:
            v = F.coalesce(v, F.lit(a.default).cast(fn.result_type))
        feats.append(v.alias(a.output_name(spec.granularity)))
    return feats


def _evaluate(rows: DataFrame, spec: AggregateSpec, bucket_width: int | None,
              scales: dict[str, int] | None = None) -> DataFrame:
    """Evaluate all aggregates at rows flagged ``__pt``; keys, ``__g``, features.

    Approximate distinct counts over at least LONG_SKETCH granules take aligned blocks of
    sketches (``operators.dyadic``), rows of their own in the same groups; one Window node holds all.
    """
    width = bucket_width or default_bucket_width(spec)
    tiled = [a for a in spec.aggs if _by_blocks(a, spec)]
    x, place, zone = _with_halo(rows, spec, width), F.col(G), 0
    if tiled:
        spans = [hi - lo + 1 for lo, hi in (a.window.frame(spec.granularity) for a in tiled)]
        # the groups are dealt out before blocks are made of their rows, so blocks are not shuffled; one that lacks rows
        # from before the halo or after the bucket lies in no frame of the bucket's points. All shuffle partitions are
        # kept, since rows grow in a task to several times the bytes that they are merged by
        x = with_blocks(x.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *spec.key, B), [*spec.key, B], [a.column for a in tiled], max(spans))
        zone = 2 * (width + spec.max_span + 1)  # no frame reaches from one level into another
        place = F.col(G) + F.col(LEVEL).cast("bigint") * F.lit(zone)
    base = Window.partitionBy(*spec.key, B).orderBy(place)
    out = x.select(*spec.key, G, B, PT, *_frame_features(spec, base, scales or {}, zone))
    return out.where((F.col(PT) == 1) & (F.col(B) == _home(width))).drop(B, PT)


def _grid_by_runs(facts: DataFrame, spec: AggregateSpec, bounds: DataFrame,
                  bucket_width: int | None, scales: dict[str, int] | None = None) -> DataFrame:
    """Grid evaluation without shuffling the grid.

    A window value can only change on a granule where some fact enters a frame
    (``g - hi``) or leaves it (``g - lo + 1``). The aggregates are evaluated at
    those change points, at each key's first granule and at each bucket start
    inside its range (all folded into the one partial aggregation); each value
    then holds until the next point of its bucket, so the dense rows are made
    by a narrow ``explode`` after the window. The shuffles carry
    O(facts x frame edges + keys x buckets) rows instead of keys x granules.

    ``bounds`` (keys, ``__s``, ``__e``) may have several disjoint runs of granules per
    key: each has its own points, and what lies between them is left out.
    """
    width = bucket_width or default_bucket_width(spec)
    frames = [a.window.frame(spec.granularity) for a in spec.aggs]
    edges = sorted({-hi for lo, hi in frames} | {-lo + 1 for lo, hi in frames})
    g = _gran(facts, spec.time, spec).cast("bigint")
    # one row per (key, granule) first, so that the edges multiply granules, not raw facts
    changes = (_clean_facts(facts, spec).select(*spec.key, g.alias(G)).distinct()
               .select(*spec.key, F.explode(F.array(*[F.col(G) + F.lit(e) for e in edges])).alias(G))
               .select(*spec.key, G, F.lit(None).cast("bigint").alias("__s"),
                       F.lit(None).cast("bigint").alias("__e")))
    wl = F.lit(width)
    starts = F.array_union(
        F.array(F.col("__s")),
        F.transform(F.sequence(F.floor(F.col("__s") / wl) + 1, F.floor(F.col("__e") / wl)), lambda b: b * wl))
    anchors = bounds.select(*spec.key, F.explode(starts).alias(G), "__s", "__e")
    rows = daily_partials(facts, spec, points=changes.unionByName(anchors), point_cols=("__s", "__e"))

    # a point becomes many dense rows, so tasks are not merged by the bytes of points: that left cores idle or a last small wave
    x = _with_halo(rows, spec, width).repartition(int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions")), *spec.key, B)
    base = Window.partitionBy(*spec.key, B).orderBy(F.col(G))
    so_far = base.rowsBetween(Window.unboundedPreceding, 0)  # a run has a point of its own in each of its buckets
    names = spec.names
    ev = x.select(*spec.key, G, B, PT, *_frame_features(spec, base, scales or {}),
                  *[F.last(c, ignorenulls=True).over(so_far).alias(c) for c in ("__s", "__e")])
    pts = ev.where((F.col(PT) == 1) & (F.col(B) == _home(width)) & F.col("__s").isNotNull())
    nxt = F.lead(G).over(base)
    pts = pts.select(*spec.key, G, B, "__s", "__e", *names, nxt.alias("__n"))
    run_end = F.coalesce(F.col("__n") - 1, (F.col(B) + 1) * wl - 1)
    lo_c = F.greatest(F.col(G), F.col("__s"))
    hi_c = F.least(run_end, F.col("__e"))
    return pts.where(lo_c <= hi_c).select(*spec.key, F.explode(F.sequence(lo_c, hi_c)).alias(G), *names)


def _facts_in_reach(facts: DataFrame, spec: AggregateSpec, spine: DataFrame, spine_time: str) -> DataFrame:
    days = spec.granularity // DAY_TD
    reach = (spec.max_span + 1) * days  # whole granules before the earliest point's granule
    bounds = spine.select(F.to_date(F.col(spine_time)).alias("__d"))
    lo = F.date_sub(bounds.select(F.min("__d")).scalar(), reach)
    hi = F.date_add(bounds.select(F.max("__d")).scalar(), days)
    t = F.col(spec.time)
    ttype = dict(facts.dtypes)[spec.time]
    if ttype == "date":
        return facts.where((t >= lo) & (t < hi))
    cast = "timestamp_ntz" if ttype == "timestamp_ntz" else "timestamp"
    return facts.where((t >= lo.cast(cast)) & (t < hi.cast(cast)))


def partials_spec_columns(spec: AggregateSpec) -> list[str]:
    """Column names of the per-(key, granule) partials ``spec`` needs."""
    return list(dict.fromkeys(aggreg.pname(kind, a.column) for a in spec.aggs
                              for kind in aggreg.get(a.fn).partials))


# how partials of each kind merge when several rows share a (key, granule)
PARTIAL_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "active": F.max,
                 "hll": F.hll_union_agg}


def from_partials(partials: DataFrame, spec: AggregateSpec, scales: dict[str, int] | None = None,
                  bucket_width: int | None = None, spine: DataFrame | None = None,
                  on: dict[str, str] | None = None) -> DataFrame:
    """Evaluate ``spec`` over a table of partials instead of raw facts.

    ``partials`` holds the spec's key columns, ``__g`` (granule number) and the
    partial columns (``partials_spec_columns``), e.g. as written by
    ``streaming.jobs.stream_partials``; ``scales`` gives the decimal scale of
    columns whose sums were kept as unscaled longs. Without ``spine`` the
    result is at every (key, granule) of the table (facts mode); with one, at
    each spine row (``on`` as in ``aggregate_features``): spine points are
    folded in with partial-merging aggregates (sum of sums, max of maxima, HLL
    unions), so rows repeating a (key, granule) merge too. One partials table
    serves any number of windows over the same columns.
    """
    cols = partials_spec_columns(spec)
    kinds = {c: c.split("__")[1][2:] for c in cols}  # "__p_<kind>__<column>"
    unknown = [c for c, k in kinds.items() if k not in PARTIAL_MERGE]
    if unknown:
        raise ValueError(f"no merge rule for partials {unknown}")
    if spine is None:
        rows = partials.withColumn(FT, F.lit(1)).withColumn(PT, F.lit(1))
        res = _evaluate(rows, spec, bucket_width, scales or {})
        return _finish(res, spec, _output_casts(spec), None)
    on = dict(on or {})
    inv = {v: k for k, v in on.items()}
    spine_keys = [inv.get(k, k) for k in spec.key]
    spine_time = inv.get(spec.time, spec.time)
    key_types = dict(partials.dtypes)
    ptypes = dict(partials.dtypes)
    pts = spine.select(*[F.col(sk).cast(key_types[k]).alias(k) for sk, k in zip(spine_keys, spec.key)],
                       _gran(spine, spine_time, spec).alias(G))
    pts = pts.where(_and([F.col(c).isNotNull() for c in [*spec.key, G]]))
    p = pts.select(*spec.key, G, *[F.lit(None).cast(ptypes[c]).alias(c) for c in cols],
                   F.lit(0).alias(FT), F.lit(1).alias(PT))
    f = partials.select(*spec.key, F.col(G).cast(dict(p.dtypes)[G]).alias(G), *cols,
                        F.lit(1).alias(FT), F.lit(0).alias(PT))
    merged = f.unionByName(p).groupBy(*spec.key, G).agg(
        *[PARTIAL_MERGE[kinds[c]](c).alias(c) for c in cols], F.max(FT).alias(FT), F.max(PT).alias(PT))
    res = _evaluate(merged, spec, bucket_width, scales or {})
    casts = _output_casts(spec)
    res = res.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(spec.key)], G,
                     *[casts[n](F.col(n)).alias(n) for n in spec.names])
    sp = spine.withColumn(G, _gran(spine, spine_time, spec))
    cond = [F.col(sk).cast(key_types[k]) == F.col(f"__k{i}") for i, (sk, k) in enumerate(zip(spine_keys, spec.key))]
    joined = sp.alias("s").join(res.alias("r"), on=_and(cond + [F.col(f"s.{G}") == F.col(f"r.{G}")]), how="left")
    return joined.select(*[F.col(f"s.{c}") for c in spine.columns], *[F.col(f"r.{n}") for n in spec.names])


def _scalar_time_bound(facts: DataFrame, spec: AggregateSpec, which: str) -> Column:
    agg = F.max if which == "end" else F.min
    return facts.select(agg(_gran(facts, spec.time, spec))).scalar()


def _bound(value, facts: DataFrame, spec: AggregateSpec, which: str) -> Column:
    if value is None:
        return _scalar_time_bound(facts, spec, which)
    if isinstance(value, Column):
        return granule(value, spec.granularity)
    if isinstance(value, str):
        return granule(F.lit(value).cast("timestamp_ntz"), spec.granularity, "timestamp_ntz")
    if isinstance(value, _dt.datetime):
        # from text: a Python datetime literal would pass through the session time zone
        return granule(F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz"),
                       spec.granularity, "timestamp_ntz")
    if isinstance(value, _dt.date):
        return granule(F.lit(value), spec.granularity, "date")
    raise TypeError(f"unsupported bound {value!r}")


def grid_bounds(facts: DataFrame, spec: AggregateSpec, entities: DataFrame | None = None,
                start_col: str | None = None, end_col: str | None = None) -> DataFrame:
    """Per key, the first and last granule of its grid: (keys, ``__s``, ``__e``).

    Keys come from ``entities`` (deduplicated, which avoids the version fan-out
    of H1) or else from the facts. Per-key bounds may come from columns of
    ``entities``; otherwise the spec's bounds, and an open bound is the earliest
    or latest time of the source (a scalar subquery, never the wall clock).
    """
    src = entities if entities is not None else _clean_facts(facts, spec)
    if start_col or end_col:
        ent = src.groupBy(*spec.key).agg(
            *([F.min(start_col).alias("__s0")] if start_col else []),
            *([F.max(end_col).alias("__e0")] if end_col else []))
    else:
        ent = src.select(*spec.key).distinct()
    et = dict(src.dtypes)
    s = (granule(F.col("__s0"), spec.granularity, et.get(start_col)) if start_col
         else _bound(spec.start, facts, spec, "start"))
    e = (granule(F.col("__e0"), spec.granularity, et.get(end_col)) if end_col
         else _bound(spec.end, facts, spec, "end"))
    out = ent.select(*spec.key, s.cast("bigint").alias("__s"), e.cast("bigint").alias("__e"))
    for k in spec.key:
        out = out.where(F.col(k).isNotNull())
    return out.where(F.col("__s") <= F.col("__e"))


def refresh_grid(grid: DataFrame, facts: DataFrame, late: DataFrame, spec: AggregateSpec,
                 bucket_width: int | None = None) -> DataFrame:
    """A grid brought up to date with ``late`` facts, without rebuilding it.

    ``grid`` is what ``mode="grid"`` gave over the facts before; ``facts`` holds all
    facts, the late ones included. A fact can change only the cells of its key whose
    windows hold its granule. These cells, new keys' whole grids and the granules beyond the
    old grid's end are evaluated over the facts of the keys touched (a semi-join);
    every other cell is kept as it is. Give the grid's first bound in ``spec.start``; an
    open end is the latest fact's granule.
    """
    time_type = dict(facts.dtypes)[spec.time]
    out_type = dict(grid.dtypes)[spec.time]
    keys = list(spec.key)
    kept = [*keys, spec.time, *spec.names]
    old = grid.select(*kept).withColumn(G, _gran(grid, spec.time, spec).cast("bigint"))
    frames = [a.window.frame(spec.granularity) for a in spec.aggs]
    first, last = min(-hi for _, hi in frames), max(-lo for lo, _ in frames)
    bounds = grid_bounds(facts, spec)
    had = old.groupBy(*keys).agg(F.max(G).alias("__last"))
    # a late fact's cells, inside its key's grid
    new = _clean_facts(late, spec).select(*keys, _gran(late, spec.time, spec).cast("bigint").alias(G)).distinct()
    cells = new.join(bounds, keys).select(*keys, F.greatest(F.col(G) + first, F.col("__s")).alias("a"), F.least(F.col(G) + last, F.col("__e")).alias("b"))
    # cells that the old grid lacks: after its end, or all of a key's
    more = bounds.join(had, keys, "left").select(*keys, F.coalesce(F.col("__last") + 1, F.col("__s")).alias("a"), F.col("__e").alias("b"))
    # written once, a few rows a key: read three times below, and a task there holds none of the sorts that made them
    runs = materialize(_disjoint(cells.unionByName(more).where(F.col("a") <= F.col("b")), keys), name="grid-runs")
    touched = runs.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)]).distinct()
    own = facts.join(touched, _and([F.col(k) == F.col(f"__t{i}") for i, k in enumerate(keys)]), "left_semi")
    scales = _decimal_scales(facts, spec)
    fresh = _grid_by_runs(_unscaled(own, scales), spec, runs, bucket_width, scales)
    fresh = _finish(fresh, spec, _output_casts(spec), time_type).withColumn(spec.time, F.col(spec.time).cast(out_type))
    # the cells stay runs here too: one row per key, whose few runs its old cells are held against
    gone = runs.groupBy(*[F.col(k).alias(f"__c{i}") for i, k in enumerate(keys)]).agg(F.collect_list(F.struct("__s", "__e")).alias("__runs"))
    stays = old.join(gone, _and([F.col(k) == F.col(f"__c{i}") for i, k in enumerate(keys)]), "left").where(
        F.col("__runs").isNull() | ~F.exists("__runs", lambda r: F.col(G).between(r["__s"], r["__e"])))
    return stays.select(*kept).unionByName(fresh.select(*kept))


def _disjoint(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of granules ``a`` .. ``b`` merged where they overlap or touch: (keys, ``__s``, ``__e``), no granule twice."""
    w = Window.partitionBy(*keys).orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    apart = runs.withColumn("__new", F.when(F.col("a") <= reach + 1, 0).otherwise(1))
    numbered = apart.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__run").agg(F.min("a").alias("__s"), F.max("b").alias("__e")).drop("__run")


def grid_points(facts: DataFrame, spec: AggregateSpec,
                entities: DataFrame | None = None,
                start_col: str | None = None, end_col: str | None = None) -> DataFrame:
    """Every granule between start and end for each key (A9, F1, F2), exploded."""
    b = grid_bounds(facts, spec, entities, start_col, end_col)
    return b.select(*spec.key, F.explode(F.sequence("__s", "__e")).alias(G))


def grid_size(facts: DataFrame, spec: AggregateSpec, entities: DataFrame | None = None,
              start_col: str | None = None, end_col: str | None = None) -> int:
    """Number of grid cells, summed per key without building the grid."""
    b = grid_bounds(facts, spec, entities, start_col, end_col)
    return b.agg(F.sum(F.col("__e") - F.col("__s") + 1)).first()[0] or 0


def aggregate_features(facts: DataFrame, spec: AggregateSpec, spine: DataFrame | None = None,
                       mode: str = "spine", on: dict[str, str] | None = None,
                       entities: DataFrame | None = None, start_col: str | None = None,
                       end_col: str | None = None, bucket_width: int | None = None,
                       max_cells: int | None = None, prune_facts: bool = False,
                       prefilter=False) -> DataFrame:
    """Evaluate ``spec`` over ``facts``.

    * ``mode="spine"``: at each row of ``spine`` (all spine columns kept, same
      row count). ``on`` maps spine columns to the spec's key/time names, e.g.
      ``{"primary_account_number": "account_id", "observation_date": "txn_date"}``.
    * ``mode="facts"``: at every granule holding facts (a sparse time-series
      feature table keyed by (key, time)).
    * ``mode="grid"``: at every granule from start to end for every key.

    Sums and averages of money come out as double, counts as bigint.
    ``max_cells`` guards grid mode: the grid size (keys x granules) is counted
    first, by one aggregate over the keys, and a larger grid is refused.
    ``prune_facts`` (spine mode, day grains; for narrow spines such as one
    day of requests) keeps only facts some spine row can reach: from the
    earliest observation minus the longest window to the latest observation,
    as a filter on the raw time column against two scalar subqueries over the
    spine, so a date-partitioned fact table is pruned at the scan. It costs
    one more pass over the spine's time column, so it is off by default.
    """
    cast_out = _output_casts(spec)
    scales = _decimal_scales(facts, spec)
    time_type = dict(facts.dtypes).get(spec.time)
    if mode in ("facts", "grid"):
        facts = _unscaled(facts, scales)
    if mode == "facts":
        res = _evaluate(daily_partials(facts, spec), spec, bucket_width, scales)
        return _finish(res, spec, cast_out, time_type)
    if mode == "grid":
        if max_cells is not None:
            cells = grid_size(facts, spec, entities, start_col, end_col)
            if cells > max_cells:
                raise ValueError(f"grid of {cells} cells exceeds max_cells={max_cells}; "
                                 "use spine mode or narrow start/end")
        res = _grid_by_runs(facts, spec, grid_bounds(facts, spec, entities, start_col, end_col),
                            bucket_width, scales)
        return _finish(res, spec, cast_out, time_type)
    if mode != "spine":
        raise ValueError("mode must be 'spine', 'grid' or 'facts'")
    if spine is None:
        raise ValueError("spine mode needs a spine DataFrame")
    on = dict(on or {})
    inv = {v: k for k, v in on.items()}
    spine_keys = [inv.get(k, k) for k in spec.key]
    spine_time = inv.get(spec.time, spec.time)
    missing = [c for c in spine_keys + [spine_time] if c not in spine.columns]
    if missing:
        raise ValueError(f"spine lacks columns {missing}")
    clash = [n for n in spec.names if n in spine.columns]
    if clash:
        raise ValueError(f"aggregate names already in the spine: {clash}")
    key_types = dict(facts.dtypes)
    res = point_features(facts, spec, spine, spine_keys, spine_time, bucket_width, prune_facts, prefilter)
    sp = spine.withColumn(G, _gran(spine, spine_time, spec))
    cond = [F.col(sk).cast(key_types[k]) == F.col(f"__k{i}") for i, (sk, k) in enumerate(zip(spine_keys, spec.key))]
    joined = sp.alias("s").join(res.alias("r"), on=_and(cond + [F.col(f"s.{G}") == F.col(f"r.{G}")]),
                                how="left")
    return joined.select(*[F.col(f"s.{c}") for c in spine.columns],
                         *[F.col(f"r.{n}") for n in spec.names])


def point_features(facts: DataFrame, spec: AggregateSpec, spine: DataFrame, spine_keys: Sequence[str],
                   spine_time: str, bucket_width: int | None = None, prune_facts: bool = False,
                   prefilter=False) -> DataFrame:
    """The aggregates at every distinct (key, granule) point of ``spine``, before
    any re-attach: columns ``__k0..`` (the spec's key types), ``__g`` and the
    aggregates. Callers holding several point-keyed feature tables for the
    same spine can join them first and re-attach the spine once. With
    ``prefilter=True`` the facts are first cut to the spine's keys
    (``restrict_to_spine_keys``)."""
    from .lookup import check_key_types, restrict_to_spine_keys

    spine_keys = list(spine_keys)
    check_key_types(spine, spine_keys, facts, list(spec.key))
    facts = restrict_to_spine_keys(facts, list(spec.key), spine, spine_keys, prefilter=prefilter)
    key_types = dict(facts.dtypes)
    scales = _decimal_scales(facts, spec)
    cast_out = _output_casts(spec)
    if prune_facts and spec.granularity >= DAY_TD:
        facts = _facts_in_reach(facts, spec, spine, spine_time)
    facts = _unscaled(facts, scales)
    pts = spine.select(*[F.col(sk).cast(key_types[k]).alias(k) for sk, k in zip(spine_keys, spec.key)],
                       _gran(spine, spine_time, spec).alias(G)).where(F.col(G).isNotNull())
    for k in spec.key:
        pts = pts.where(F.col(k).isNotNull())
    res = _evaluate(daily_partials(facts, spec, points=pts), spec, bucket_width, scales)
    return res.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(spec.key)], G,
                      *[cast_out[n](F.col(n)).alias(n) for n in spec.names])


def _and(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _output_casts(spec: AggregateSpec):
    casts = {}
    for a in spec.aggs:
        fn = aggreg.get(a.fn)
        t = fn.result_type
        casts[a.output_name(spec.granularity)] = (lambda c, t=t, n=a.digits: c.cast(t) if n is None else F.round(c.cast(t), n))
    return casts


def _finish(res: DataFrame, spec: AggregateSpec, casts, dtype: str | None = None) -> DataFrame:
    return res.select(*spec.key, granule_start(G, spec.granularity, dtype).alias(spec.time),
                      *[casts[n](F.col(n)).alias(n) for n in spec.names])


def rolling_7_14_spec(key: str | Sequence[str], time: str, amount: str,
                      closed: str = "right") -> AggregateSpec:
    """The reference's rollups: 14- and 7-day totals and 7-day active days.

    Output names are the reference's ``14_day_total``, ``7_day_total`` and
    ``7_day_transaction_count`` (which counts active days, H4).
    """
    return AggregateSpec(key, time, [
        Agg(amount, "sum", Lookback(14, closed=closed), name="14_day_total"),
        Agg(amount, "sum", Lookback(7, closed=closed), name="7_day_total"),
        Agg(amount, "active_days", Lookback(7, closed=closed), name="7_day_transaction_count"),
    ])


def dense_daily(facts: DataFrame, spec: AggregateSpec, entities: DataFrame,
                start_col: str, end: object = None, bucket_width: int | None = None) -> DataFrame:
    """Dense per-(key, day) rollups from each entity's start to ``end``.

    The reference joins a calendar to raw facts and sums rows frames; here the
    calendar is joined by position in the window instead (same answer, H6),
    entities are deduplicated first (H1) and empty frames give 0, as a calendar
    filled with zero amounts would.
    """
    aggs = [Agg(a.column, a.fn, a.window, default=0 if a.default is None else a.default,
                name=a.name) for a in spec.aggs]
    dense = AggregateSpec(spec.key, spec.time, aggs, start=spec.start, end=end,
                          granularity=spec.granularity, source=spec.source)
    return aggregate_features(facts, dense, mode="grid", entities=entities,
                              start_col=start_col, bucket_width=bucket_width)


def daily_totals(facts: DataFrame, key: str | Sequence[str], time: str, amount: str) -> DataFrame:
    """Daily SUM and activity flag per (key, day) (A1, F7): ``daily_total`` as
    double, ``transaction_occurred`` = 1 when the day holds a positive amount."""
    keys = [key] if isinstance(key, str) else list(key)
    day = F.to_date(F.col(time))
    return facts.groupBy(*keys, day.alias(time)).agg(
        F.sum(amount).cast("double").alias("daily_total"),
        F.max(F.when(F.col(amount) > 0, 1).otherwise(0)).cast("bigint").alias("transaction_occurred"))
