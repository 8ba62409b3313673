"""Feature lookups against dimensions and time-series tables.

All lookups are LEFT joins: the spine keeps its row count and order of
columns; a key absent from the right side, a NULL key or a NULL time yields
NULL features (H8).

As-of plan (``strategy="union"``, the default; SURVEY 4.3.3 made skew-proof):

1. the spine's distinct (key, time) points (a hash aggregation, map-side
   combined) and the rows of every right table are laid under one another; each
   right row carries ``struct(time, tie-breakers, features)``, so that its
   running max is the latest row, ties broken deterministically, a NULL feature
   kept as NULL. Right rows cross the network once and are never sorted for an
   aggregation: their (key, time) is declared unique. ``AsOfRight(unique=False)``
   first reduces a raw log to one row per (key, time), map-side combined;
2. a window per key ordered by (time, kind of row) takes the running max of each
   struct. The kind puts a point behind the right rows of its own time, or before
   them for a strict lookup. With DATE times a key's group is bounded by its
   calendar days. Finer times (``bucket`` given, or ``"auto"`` with timestamps)
   cut keys into (key, time bucket) groups; a point without a row in its bucket
   takes the last row of the latest earlier bucket, found by a window over one
   row per (key, bucket), so one key with a huge history spreads over many tasks,
   and a bucket with very many rows of one key is cut further at quantiles of its times;
3. the spine rows are re-attached by an equi-join on (key, time), which AQE's
   skew join can split when one point is hot; duplicate spine rows survive.

Several as-of lookups on the same spine key and time share steps 1-3 (one
window pass, one join back), however many right tables there are.

``strategy="broadcast"`` packs each right key's rows into an array, broadcasts
it after checking its row count, and picks the latest qualifying element with
``array_max(filter(..))``: no shuffle of the spine at all. Beyond the limit it
falls back to the union plan. ``strategy="packed"``, for streaming spines, has no
window over the spine: two equi joins against chunks of each key's versions.

For a few requests, ``prefilter=True`` first cuts every right table to the
spine's keys with a semi-join, so serving does not shuffle whole feature tables
(``restrict_to_spine_keys``); it is off by default.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import epoch_seconds
from .buckets import HOT_ROWS, time_buckets

DEFAULT_BUCKET = _dt.timedelta(days=1)
#: Versions in a chunk, and chunks in a directory row, of the windowless as-of join.
CHUNK_ROWS = 1_000
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_PER_KEY = 1_000
DEFAULT_SMALL_SPINE = 100_000

#: Order of rows of equal time in the as-of window.
ROW, POINT, STRICT_ROW = 0, 1, 2


def restrict_to_spine_keys(df: DataFrame, key: Sequence[str], spine: DataFrame, spine_key: Sequence[str],
                           prefilter="auto", small_spine: int = DEFAULT_SMALL_SPINE) -> DataFrame:
    """Keep only rows of ``df`` whose key occurs in a small spine.

    Serving a few requests should not shuffle a whole feature table. Lookups and
    aggregates do this only when their caller passes ``prefilter=True``: a plain
    semi-join with the spine's distinct keys, whose plan Spark chooses, and no
    job. ``prefilter="auto"`` first counts the spine (a job) and broadcasts its
    keys only if they are ``small_spine`` rows at most. Keys are compared in the
    table's type, the type in which the lookups compare them. A streaming spine
    is left alone.
    """
    if prefilter is False or spine.isStreaming:
        return df
    if prefilter == "auto" and not _fits(spine, small_spine):
        return df
    sk = spine.select(*[F.col(k).alias(f"__sk{i}") for i, k in enumerate(spine_key)])
    sk = sk.where(_and([F.col(f"__sk{i}").isNotNull() for i in range(len(spine_key))])).distinct()
    types = dict(df.dtypes)
    cond = _and([df[k] == sk[f"__sk{i}"].cast(types[k]) for i, k in enumerate(key)])
    return df.join(F.broadcast(sk) if prefilter == "auto" else sk, cond, "left_semi")


def _key_kind(dtype: str) -> str:
    if dtype in ("tinyint", "smallint", "int", "bigint") or dtype.startswith("decimal"):
        return "exact number"
    return "floating number" if dtype in ("float", "double") else dtype


def check_key_types(left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str]) -> None:
    """Refuse key pairs whose comparison would lose digits or depend on a cast (H9)."""
    lt, rt = dict(left.dtypes), dict(right.dtypes)
    bad = [f"{a} {lt[a]} = {b} {rt[b]}" for a, b in zip(left_keys, right_keys) if _key_kind(lt[a]) != _key_kind(rt[b])]
    if bad:
        raise ValueError(f"keys of unlike types, cast one side first: {', '.join(bad)}")




def _ls(v) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def _and(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _check(df: DataFrame, cols: Sequence[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns {missing} not in {df.columns}")


def _out_names(features: Sequence[str], rename: dict | None) -> list[str]:
    rename = rename or {}
    return [rename.get(f, f) for f in features]


def _clash(spine: DataFrame, names: Sequence[str]) -> None:
    dup = [n for n in names if n in spine.columns]
    if dup:
        raise ValueError(f"feature names already in the spine: {dup}; use rename=")


# --------------------------------------------------------------------------
# exact-key lookup
# --------------------------------------------------------------------------
def lookup_exact(spine: DataFrame, right: DataFrame, lookup_key, right_key, features,
                 rename: dict | None = None, unique: str = "trust", prefilter=False) -> DataFrame:
    """LEFT equi-join of ``features`` of a type-1 table keyed by ``right_key``.

    Keys are matched by position (H10) and compared in their common type (H9).
    The right key is declared unique (``TableSpec``); ``quality.validate_unique``
    checks it; ``unique="enforce"`` instead keeps one row per key (the max of
    the feature struct: deterministic) with a map-side combined aggregate, so
    the spine can never fan out. Whether the right side is broadcast is left to
    AQE, which measures its actual size at run time against
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise shuffles.
    A LEFT join can only broadcast its right side; for a small spine,
    ``prefilter=True`` first cuts the dimension to the spine's keys, after which
    AQE can broadcast what is left of it.
    """
    lk, rk, feats = _ls(lookup_key), _ls(right_key), _ls(features)
    if len(lk) != len(rk):
        raise ValueError("lookup_key and right key differ in length")
    _check(spine, lk, "spine")
    _check(right, rk + feats, "right")
    check_key_types(spine, lk, right, rk)
    names = _out_names(feats, rename)
    _clash(spine, names)
    right = restrict_to_spine_keys(right, rk, spine, lk, prefilter=prefilter)
    r = right.select(*[F.col(k).alias(f"__rk{i}") for i, k in enumerate(rk)],
                     *[F.col(f).alias(n) for f, n in zip(feats, names)])
    if unique == "enforce":
        rks = [f"__rk{i}" for i in range(len(rk))]
        r = r.groupBy(*rks).agg(F.max(F.struct(*names)).alias("__m")).select(
            *rks, *[F.col(f"__m.{n}").alias(n) for n in names])
    elif unique != "trust":
        raise ValueError("unique must be 'trust' or 'enforce'")
    cond = _and([spine[k] == r[f"__rk{i}"] for i, k in enumerate(lk)])
    return spine.join(r, cond, "left").select(*[spine[c] for c in spine.columns],
                                              *[r[n] for n in names])


# --------------------------------------------------------------------------
# interval lookup
# --------------------------------------------------------------------------
def lookup_interval(spine: DataFrame, right: DataFrame, lookup_key, right_key, spine_time: str,
                    valid_from: str, valid_to: str, features, rename: dict | None = None,
                    strategy: str = "asof_nonoverlapping", bucket: _dt.timedelta | str | None = "auto") -> DataFrame:
    """Version valid at the observation: ``valid_from <= t < valid_to`` (NULL = open).

    ``strategy="asof_nonoverlapping"`` (default) picks the latest version
    starting at or before ``t`` with the as-of plan and keeps it only if it is
    still valid at ``t``: linear in the data, one row per spine row, and the same
    answer as the interval join where versions of a key do not overlap (what
    ``build_scd2`` produces; ``quality.validate_versions`` lists overlaps). Its
    name states that contract. Zero-length versions never match.

    ``strategy="join"`` is the literal range join: every version that holds
    ``t`` matches (a spine row may repeat where versions overlap). Versions are dealt
    by length into levels of spans (1 second, 16, 256, ..), each into the one or two spans
    of its level that it touches; a spine row looks into one span per level that the right
    table has, so an equi-join on (key, level, span) leaves only versions whose length
    is at least a sixteenth of the span, and none is compared with all of its key's. (Spans
    that double would leave fewer, but send each spine row to four times the levels.)
    Open versions end with the last time of the spine.
    """
    lk, rk, feats = _ls(lookup_key), _ls(right_key), _ls(features)
    _check(spine, lk + [spine_time], "spine")
    _check(right, rk + [valid_from, valid_to] + feats, "right")
    names = _out_names(feats, rename)
    _clash(spine, names)
    if strategy == "asof_nonoverlapping":
        r = right.withColumn("__vt_chk", F.col(valid_to))
        pick = AsOfRight(r, rk, valid_from, feats + ["__vt_chk"], rename=dict(rename or {}), valid_to=valid_to)
        out = lookup_asof(spine, [pick], lk, spine_time, bucket=bucket)
        t = F.col(spine_time)
        ok = F.col("__vt_chk").isNull() | (t < F.col("__vt_chk"))
        return out.select(*[F.col(c) for c in spine.columns],
                          *[F.when(ok, F.col(n)).alias(n) for n in names])
    if strategy != "join":
        raise ValueError("strategy must be 'asof_nonoverlapping' or 'join'")
    return _interval_join(spine, right, lk, rk, spine_time, valid_from, valid_to, feats, names)


#: Levels of spans: level n has spans of 2 ** n seconds, n a multiple of STRIDE; the last holds all longer versions in one span.
LEVELS, STRIDE = 36, 4


def _interval_join(spine: DataFrame, right: DataFrame, lk: list[str], rk: list[str], spine_time: str,
                   valid_from: str, valid_to: str, feats: list[str], names: list[str]) -> DataFrame:
    """All versions with ``valid_from <= t < valid_to`` per spine row, by spans of time."""
    types, rtypes = dict(spine.dtypes), dict(right.dtypes)
    r = right.select(*[F.col(k).alias(f"__rk{i}") for i, k in enumerate(rk)], F.col(valid_from).alias("__vf"), F.col(valid_to).alias("__vt"),
                     *[F.col(f).alias(n) for f, n in zip(feats, names)])
    r = r.where(_and([F.col(f"__rk{i}").isNotNull() for i in range(len(rk))]) & F.col("__vf").isNotNull()
                & (F.col("__vt").isNull() | (F.col("__vf") < F.col("__vt"))))
    start, end = (epoch_seconds(c, rtypes[n]) for c, n in (("__vf", valid_from), ("__vt", valid_to)))
    length = F.log2((end - start + 1).cast("double"))  # of the seconds it may touch
    level = F.when(F.col("__vt").isNull(), F.lit(LEVELS)).otherwise(F.least(F.ceil(length / STRIDE) * STRIDE, F.lit(LEVELS))).cast("int")
    r = r.withColumn("__level", level)
    size = F.expr("shiftleft(1L, __level)")
    span = lambda x: F.when(F.col("__level") == LEVELS, F.lit(0)).otherwise(F.floor(x / size)).cast("bigint")
    r = r.withColumn("__span", F.explode(F.array_distinct(F.array(span(start), F.coalesce(span(end), F.lit(0).cast("bigint"))))))
    used = r.select(F.collect_set("__level")).scalar()  # LEVELS / STRIDE + 1 numbers at most
    ks = [f"__k{i}" for i in range(len(lk))]
    points = spine.select(*[F.col(k).alias(kk) for k, kk in zip(lk, ks)], F.col(spine_time).alias("__t"))
    points = points.where(_and([F.col(c).isNotNull() for c in ks + ["__t"]])).distinct()
    look = points.withColumn("__used", used).withColumn("__look", F.explode("__used"))
    look = look.withColumn("__place", F.when(F.col("__look") == LEVELS, F.lit(0)).otherwise(
        F.floor(epoch_seconds("__t", types[spine_time]) / F.expr("shiftleft(1L, __look)"))).cast("bigint"))
    held = _and([F.col(kk) == F.col(f"__rk{i}") for i, kk in enumerate(ks)]
                + [F.col("__look") == F.col("__level"), F.col("__place") == F.col("__span"),
                   F.col("__vf") <= F.col("__t"), F.col("__vt").isNull() | (F.col("__t") < F.col("__vt"))])
    got = look.join(r, held).select(*ks, "__t", *names)
    same = _and([spine[k] == got[kk] for k, kk in zip(lk, ks)] + [spine[spine_time] == got["__t"]])
    return spine.join(got, same, "left").select(*[spine[c] for c in spine.columns], *[got[n] for n in names])


# --------------------------------------------------------------------------
# as-of lookup
# --------------------------------------------------------------------------
@dataclass
class AsOfRight:
    """One right table of an as-of lookup.

    ``order_by`` breaks ties between rows of equal time: the row that sorts
    last wins (H11). The default prefers an open version (``valid_to`` NULL)
    and then the greatest ``valid_to`` when ``valid_to`` is given.
    """

    df: DataFrame
    key: list[str]
    time: str
    features: list[str]
    rename: dict = field(default_factory=dict)
    order_by: list[Column] = field(default_factory=list)
    valid_to: str | None = None
    # strict: only rows strictly before the observation time (no same-time leakage, H3)
    strict: bool = False
    # few rows share a (key, time), as TableSpec declares; False reduces a raw log first.
    # The answer is the same: this chooses the plan alone
    unique: bool = True

    def names(self) -> list[str]:
        return _out_names(self.features, self.rename)

    def tiebreak(self) -> list[Column]:
        out = []
        if self.valid_to:
            vt = F.col(self.valid_to)
            out += [vt.isNull().alias("__open"), vt.alias("__vt")]
        return out + [c.alias(f"__tb{i}") for i, c in enumerate(self.order_by)]


def _value_struct(r: AsOfRight, idx: int) -> Column:
    """struct(time, tie-breakers, features): its max is the as-of pick."""
    feats = F.struct(*[F.col(f).alias(n) for f, n in zip(r.features, r.names())])
    return F.struct(F.col(r.time).alias("t"), F.struct(*r.tiebreak(), F.lit(0).alias("__z")).alias("o"),
                    feats.alias("f")).alias(f"__v{idx}")


def lookup_asof(spine: DataFrame, rights: Sequence[AsOfRight], lookup_key, spine_time: str,
                strategy: str = "union", bucket: _dt.timedelta | str | None = "auto",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                max_per_key: int = DEFAULT_MAX_PER_KEY, prefilter=False,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Latest right row with ``time <= spine_time`` per spine row, for each right table.

    ``strategy="broadcast"`` is taken only when every right table has at most
    ``max_broadcast_rows`` rows and at most ``max_per_key`` rows per key (each
    spine row scans its key's array); otherwise the union plan runs. There a
    (key, time bucket) of more than ``hot_rows`` rows is cut at quantiles of its
    times (``operators.buckets``). ``strategy="packed"`` also takes a streaming spine
    (``_asof_chunks``).
    """
    lk = _ls(lookup_key)
    _check(spine, lk + [spine_time], "spine")
    names: list[str] = []
    for r in rights:
        _check(r.df, r.key + [r.time] + r.features + ([r.valid_to] if r.valid_to else []), "right")
        if len(r.key) != len(lk):
            raise ValueError("lookup_key and right key differ in length")
        check_key_types(spine, lk, r.df, list(r.key))
        names += r.names()
    _clash(spine, names)
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate feature names across lookups: {names}")
    if strategy == "packed":
        # no window: also valid when the spine is a stream (stream-static join)
        out = spine
        for i, r in enumerate(rights):
            out = _asof_chunks(out, r, lk, spine_time, i, hot_rows=hot_rows)
        return out
    if strategy == "broadcast":
        if all(_fits(r.df, max_broadcast_rows, r.key, max_per_key) for r in rights):
            out = spine
            for i, r in enumerate(rights):
                out = _asof_packed(out, r, lk, spine_time, i)
            return out
        strategy = "packed" if spine.isStreaming else "union"
        if strategy == "packed":
            return lookup_asof(spine, rights, lk, spine_time, strategy="packed", hot_rows=hot_rows)
    if strategy != "union":
        raise ValueError("strategy must be 'union', 'broadcast' or 'packed'")
    return _asof_union(spine, list(rights), lk, spine_time, bucket, prefilter, hot_rows)


def _fits(df: DataFrame, max_rows: int, key: Sequence[str] | None = None,
          max_per_key: int | None = None) -> bool:
    """Size check by a count per task (no row leaves its task); then, on a
    small input only, the largest number of rows of one key."""
    if df.count() > max_rows:
        return False
    if key and max_per_key:
        top = df.groupBy(*key).count().agg(F.max("count")).first()[0]
        return (top or 0) <= max_per_key
    return True


def _latest_per_time(r: AsOfRight, i: int) -> DataFrame:
    """``__rk0..``, ``__t`` and ``__v``: the tie-broken latest row per (key, time)."""
    v = _value_struct(r, i)
    keyed = r.df.where(_and([F.col(k).isNotNull() for k in r.key] + [F.col(r.time).isNotNull()]))
    return keyed.groupBy(*[F.col(k).alias(f"__rk{j}") for j, k in enumerate(r.key)], F.col(r.time).alias("__t")).agg(F.max(v).alias("__v"))


def _asof_packed(spine: DataFrame, r: AsOfRight, lk: list[str], spine_time: str, i: int) -> DataFrame:
    """Broadcast each key's rows as one array; keep the latest at or before t.

    For right tables whose rows, in all and per key, have been counted (``_fits``).
    """
    rks = [f"__rk{j}" for j in range(len(r.key))]
    packed = _latest_per_time(r, i).groupBy(*rks).agg(F.collect_list("__v").alias("__arr"))
    t = spine[spine_time]
    cond = _and([spine[k] == packed[f"__rk{j}"] for j, k in enumerate(lk)])
    j = spine.join(F.broadcast(packed), cond, "left")
    pick = F.array_max(F.filter(F.col("__arr"), (lambda x: x["t"] < t) if r.strict else (lambda x: x["t"] <= t)))
    return j.select(*[spine[c] for c in spine.columns],
                    *[pick["f"][n].alias(n) for n in r.names()])


def _asof_chunks(spine: DataFrame, r: AsOfRight, lk: list[str], spine_time: str, i: int,
                 hot_rows: int | None = HOT_ROWS, chunk: int | None = None, fan: int | None = None) -> DataFrame:
    """As-of join without a window over the spine, so also for a streaming one.

    Each key's versions are numbered in time order (inside bounded time buckets, plus
    the buckets before) and cut into chunks of ``chunk``; chunks are listed in directory
    rows of ``fan`` first times each. A spine row joins the directory row whose
    time range holds it, finds its chunk there, joins that chunk and picks: two equi
    joins, at most one match each, and no array longer than ``chunk`` or ``fan``,
    however long a key's history is.
    """
    chunk, fan = chunk or CHUNK_ROWS, fan or CHUNK_ROWS
    rks = [f"__rk{j}" for j in range(len(r.key))]
    rows = time_buckets(_latest_per_time(r, i), rks, "__t", DEFAULT_BUCKET, hot_rows)
    sums = rows.groupBy(*[F.col(k).alias(f"__s{k}") for k in (*rks, "__b")]).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*[f"__s{k}" for k in rks]).orderBy("__s__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    rows = rows.join(sums, _and([F.col(k) == F.col(f"__s{k}") for k in (*rks, "__b")]))
    inside = Window.partitionBy(*rks, "__b").orderBy("__t")
    number = F.col("__before") + F.row_number().over(inside) - 1
    rows = rows.select(*rks, "__t", "__v", F.floor(number / F.lit(chunk)).cast("bigint").alias("__c"))
    chunks = rows.groupBy(*rks, "__c").agg(F.collect_list("__v").alias("__arr"), F.min("__t").alias("__lo"))
    listed = chunks.groupBy(*rks, F.floor(F.col("__c") / F.lit(fan)).alias("__d")).agg(
        F.collect_list(F.struct(F.col("__lo").alias("lo"), F.col("__c").alias("c"))).alias("__dir"), F.min("__lo").alias("__from"))
    listed = listed.select(*[F.col(k).alias(f"__d{k}") for k in rks], "__dir", "__from",
                           F.lead("__from").over(Window.partitionBy(*rks).orderBy("__d")).alias("__to"))
    t = spine[spine_time]
    reached = (lambda x: x < t) if r.strict else (lambda x: x <= t)
    at = _and([spine[k] == listed[f"__d{rk}"] for k, rk in zip(lk, rks)]
              + [reached(listed["__from"]), listed["__to"].isNull() | ~reached(listed["__to"])])
    place = F.array_max(F.filter(F.col("__dir"), lambda x: reached(x["lo"])))["c"]
    found = spine.join(listed, at, "left").select(*[spine[c] for c in spine.columns], place.alias("__at"))
    chunks = chunks.select(*[F.col(k).alias(f"__c{k}") for k in rks], F.col("__c").alias("__cc"), "__arr")
    same = _and([found[k] == chunks[f"__c{rk}"] for k, rk in zip(lk, rks)] + [found["__at"] == chunks["__cc"]])
    t = found[spine_time]
    pick = F.array_max(F.filter(F.col("__arr"), (lambda x: x["t"] < t) if r.strict else (lambda x: x["t"] <= t)))
    return found.join(chunks, same, "left").select(*[found[c] for c in spine.columns], *[pick["f"][n].alias(n) for n in r.names()])


def _time_type(df: DataFrame, col: str) -> str:
    return dict(df.dtypes)[col]


def _asof_union(spine: DataFrame, rights: list[AsOfRight], lk: list[str], spine_time: str,
                bucket, prefilter=False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    got = asof_point_features(spine, rights, lk, spine_time, bucket, prefilter, hot_rows)
    ks = [f"__k{i}" for i in range(len(lk))]
    cond = _and([spine[k] == got[kk] for k, kk in zip(lk, ks)] + [spine[spine_time] == got["__t"]])
    j = spine.join(got, cond, "left")
    return j.select(*[spine[c] for c in spine.columns], *[got[n] for r in rights for n in r.names()])


def asof_point_features(spine: DataFrame, rights: Sequence[AsOfRight], lookup_key, spine_time: str,
                        bucket="auto", prefilter=False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """The as-of features at every distinct (key, time) point of ``spine``,
    before any re-attach: columns ``__k0..``, ``__t`` and the feature names.
    With ``prefilter=True`` the right tables are first cut to the spine's keys
    (``restrict_to_spine_keys``)."""
    lk = _ls(lookup_key)
    rights = list(rights)
    if rights and prefilter is not False and not spine.isStreaming:
        rights = [AsOfRight(restrict_to_spine_keys(r.df, r.key, spine, lk, prefilter=prefilter), r.key, r.time,
                            r.features, r.rename, r.order_by, r.valid_to, r.strict, r.unique) for r in rights]
    n = len(rights)
    ks = [f"__k{i}" for i in range(len(lk))]
    vcols = [f"__v{i}" for i in range(n)]
    if bucket == "auto":
        # DATE times bound every key's group by its calendar days; finer times need buckets
        dates = _time_type(spine, spine_time) == "date" and all(_time_type(r.df, r.time) == "date" for r in rights)
        bucket = None if dates else DEFAULT_BUCKET

    vals = [_value_struct(r, i) for i, r in enumerate(rights)]
    vtypes = {f"__v{i}": dict(r.df.select(v).dtypes)[f"__v{i}"] for i, (r, v) in enumerate(zip(rights, vals))}

    def nonnull(df: DataFrame) -> DataFrame:
        return df.where(_and([F.col(c).isNotNull() for c in ks + ["__t"]]))

    def shaped(df: DataFrame, keys: list[str], time: str, kind: int, own: int | None) -> DataFrame:
        cols = [F.col(k).alias(kk) for k, kk in zip(keys, ks)] + [F.col(time).alias("__t"), F.lit(kind).alias("__o")]
        for i, v in enumerate(vcols):
            cols.append(vals[i] if i == own else F.lit(None).cast(vtypes[v]).alias(v))
        return nonnull(df.select(*cols))

    def right_rows(i: int, r: AsOfRight) -> DataFrame:
        out = shaped(r.df, r.key, r.time, STRICT_ROW if r.strict else ROW, i)
        if r.unique:
            return out
        return out.groupBy(*ks, "__t", "__o").agg(*[F.max(v).alias(v) for v in vcols])

    points = nonnull(spine.select(*[F.col(k).alias(kk) for k, kk in zip(lk, ks)], F.col(spine_time).alias("__t"))).distinct()
    rows = points.select(*ks, "__t", F.lit(POINT).alias("__o"), *[F.lit(None).cast(vtypes[v]).alias(v) for v in vcols])
    for i, r in enumerate(rights):
        rows = rows.unionByName(right_rows(i, r))

    group = list(ks)
    if bucket is not None:
        rows = time_buckets(rows, ks, "__t", bucket, hot_rows)
        group.append("__b")
    w = Window.partitionBy(*group).orderBy("__t", "__o")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    got = rows.select(*group, "__t", "__o", *[F.max(v).over(upto).alias(v) for v in vcols],
                      *([F.lead("__t").over(w).isNull().alias("__last")] if bucket is not None else []))
    if bucket is not None:
        # the last row of a bucket holds all that the bucket knows; later buckets carry it in
        wb = Window.partitionBy(*ks).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        carry = got.where("__last").select(*[F.col(k).alias(f"__c{k}") for k in group],
                                           *[F.max(v).over(wb).alias(f"__c{v}") for v in vcols])
        cond = _and([F.col(k) == F.col(f"__c{k}") for k in group])
        got = (got.where(F.col("__o") == POINT).join(carry, cond, "left")
               .select(*ks, "__t", "__o", *[F.coalesce(v, f"__c{v}").alias(v) for v in vcols]))
    got = got.where(F.col("__o") == POINT)
    feats = [F.col(f"__v{i}")["f"][nme].alias(nme) for i, r in enumerate(rights) for nme in r.names()]
    return got.select(*ks, "__t", *feats)
