"""Training and inference sets: a spine plus lookups and bound functions.

``training_set`` compiles a list of ``FeatureLookup`` / ``FeatureFunction``
into one lazy DataFrame (J7, T1-T3): exact lookups become LEFT equi-joins,
as-of lookups that share a spine key and time are evaluated in one shared
window pass (one shuffle, one join back), functions become Column expressions
over earlier outputs. The row count always equals the spine's.
"""

from __future__ import annotations

import warnings
from dataclasses import replace
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import (AsOfRight, asof_point_features, lookup_asof,
                                lookup_exact)
from ..operators.rolling import aggregate_features, point_features
from ..operators.scd import latest_snapshot
from ..session import materialize
from ..specs import (DAY, Agg, AggregateSpec, Feature, FeatureAggregation, FeatureFunction, FeatureLookup,
                     FeatureSpec, TableSpec, drop_existing)


@dataclass
class FeatureTable:
    """A feature table: its DataFrame, key declaration and SCD-2 end column."""

    df: DataFrame
    spec: TableSpec
    valid_to: str | None = None


def _table(tables: Mapping[str, object], name: str) -> FeatureTable:
    t = tables[name]
    if isinstance(t, FeatureTable):
        return t
    if isinstance(t, tuple):
        return FeatureTable(*t)
    raise TypeError(f"table {name!r}: expected FeatureTable or (df, TableSpec[, valid_to])")


def apply_function(df: DataFrame, f: FeatureFunction) -> DataFrame:
    cols = [F.col(c) for _, c in f.bindings]
    missing = [c for _, c in f.bindings if c not in df.columns]
    if missing:
        raise ValueError(f"function {f.output}: inputs {missing} not available")
    if callable(f.fn):
        expr: Column = f.fn(*cols)
    else:
        expr = F.call_function(f.fn, *cols)
    return df.withColumn(f.output, expr)


def _lookup_right(lk: FeatureLookup, t: FeatureTable) -> AsOfRight:
    if not t.spec.time_key:
        raise ValueError(f"{lk.table}: as-of lookup needs a table time key")
    return AsOfRight(df=t.df, key=list(t.spec.key), time=t.spec.time_key,
                     features=list(lk.features), rename=dict(lk.rename), valid_to=t.valid_to,
                     strict=lk.strict)


def compile_features(spine: DataFrame, features: Sequence[Feature], tables: Mapping[str, object],
                     override: bool = False, asof_strategy: str = "union", prefilter=False,
                     supplied: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Attach ``features`` to ``spine``; returns (frame, output names in listed order).

    A lookup keyed on the output of an earlier one is attached after it.
    A lookup without ``time_key`` on a table with a time key reads the latest
    row per key (what an online table serves), never every version.

    With ``override`` a feature already present in the spine is kept and only
    its NULL cells are filled from the lookup or the function (T8). A lookup whose
    outputs are all named in ``supplied`` (columns the caller knows to be
    complete) or non-nullable in the schema is skipped, no join at all.
    ``prefilter=True`` cuts every table to the spine's keys first (serving a few
    requests). Building the frame starts no Spark job.
    """
    df = spine
    names: list[str] = []
    pending: list[tuple[FeatureLookup, FeatureTable]] = []
    fill: dict[str, str] = {}
    small = False if spine.isStreaming else prefilter
    given = set(supplied) & set(spine.columns)
    complete = given | {fld.name for fld in spine.schema.fields if not fld.nullable}
    if spine.isStreaming and asof_strategy == "union":
        asof_strategy = "packed"  # windows cannot run on a stream: packed stream-static joins

    def apply_fills():
        nonlocal df
        for n, tmp in list(fill.items()):
            if tmp in df.columns:
                df = df.withColumn(n, F.coalesce(F.col(n), F.col(tmp))).drop(tmp)
                del fill[n]

    exact: list[tuple[FeatureLookup, FeatureTable]] = []
    waiting: set[str] = set()  # outputs of the lookups not attached yet

    def flush():
        # point-in-time groups first, on the narrowest spine; then the exact joins
        nonlocal df, pending, exact
        groups: dict[tuple, tuple[list, list]] = {}
        for f, t in pending:
            rights, aggs = groups.setdefault((f.lookup_key, f.time_key), ([], []))
            if isinstance(f, FeatureAggregation):
                aggs.append((f, t))
            else:
                rights.append(_lookup_right(f, t))
        for (key, time), (rights, aggs) in groups.items():
            df = _attach_group(df, list(key), time, rights, aggs, asof_strategy, small)
        for f, t in exact:
            right = t.df
            if t.spec.time_key:
                # no observation time given: serve the latest row per key, as an online table would
                right = latest_snapshot(right, list(t.spec.key), t.spec.time_key)
            df = lookup_exact(df, right, list(f.lookup_key), list(t.spec.key), list(f.features),
                              rename=dict(f.rename), prefilter=small)
        pending, exact = [], []
        waiting.clear()
        apply_fills()

    for f in features:
        if not isinstance(f, FeatureFunction):
            if waiting & {*f.lookup_key, f.time_key}:
                flush()  # keyed on the output of an earlier lookup
        if isinstance(f, FeatureAggregation):
            t = _table(tables, f.table)
            out = f.output_names()
            names += out
            if override:
                if all(n in complete for n in out):
                    continue
                present = [n for n in out if n in spine.columns]
                if present:
                    aggs = [Agg(a.column, a.fn, a.window, a.default, name=f"__lk_{n}" if n in present else n)
                            for a, n in zip(f.spec.aggs, out)]
                    fill.update({n: f"__lk_{n}" for n in present})
                    sp = f.spec
                    f = FeatureAggregation(f.table, AggregateSpec(sp.key, sp.time, aggs, sp.start, sp.end,
                                                                  sp.granularity, sp.source),
                                           f.lookup_key, f.time_key)
            pending.append((f, t))
            waiting.update(out)
            continue
        if isinstance(f, FeatureFunction):
            flush()
            names.append(f.output)
            if override and f.output in spine.columns:
                if f.output not in complete:
                    tmp = f"__fn_{f.output}"
                    df = apply_function(df, replace(f, output=tmp))
                    df = df.withColumn(f.output, F.coalesce(F.col(f.output), F.col(tmp))).drop(tmp)
                continue
            df = apply_function(df, f)
            continue
        t = _table(tables, f.table)
        out = f.output_names()
        names += out
        if override:
            present = [n for n in out if n in spine.columns]
            if all(n in complete for n in out):
                continue  # supplied: no join at all
            if present:
                rename = dict(f.rename)
                for feat, n in zip(f.features, out):
                    if n in present:
                        rename[feat] = f"__lk_{n}"
                        fill[n] = f"__lk_{n}"
                f = FeatureLookup(f.table, f.features, f.lookup_key, f.time_key, rename, f.strict)
        (pending if f.time_key else exact).append((f, t))
        waiting.update(out)
    flush()
    return df, names


def _attach_group(df: DataFrame, key: list[str], time: str, rights: list[AsOfRight],
                  aggs: list[tuple[FeatureAggregation, FeatureTable]], asof_strategy: str,
                  prefilter=False) -> DataFrame:
    """Attach as-of lookups and windowed aggregates sharing (key, time).

    With DATE observation times and daily aggregates, every feature table is
    first built per distinct (key, day) point and the tables are joined on it,
    so the spine is re-attached once, however many groups there are;
    otherwise each group re-attaches on its own.
    """
    if not aggs:
        return lookup_asof(df, rights, key, time, strategy=asof_strategy, prefilter=prefilter)
    shared = (dict(df.dtypes)[time] == "date" and all(f.spec.granularity == DAY for f, _ in aggs)
              and (not rights or asof_strategy == "union"))
    if not shared:
        for f, t in aggs:
            on = {**dict(zip(key, f.spec.key)), time: f.spec.time}
            df = aggregate_features(t.df, f.spec, spine=df, on=on, prefilter=prefilter)
        return lookup_asof(df, rights, key, time, strategy=asof_strategy, prefilter=prefilter) if rights else df
    ks = [f"__k{i}" for i in range(len(key))]
    base = asof_point_features(df, rights, key, time, prefilter=prefilter) if rights else None
    names = [n for r in rights for n in r.names()]
    epoch = F.lit("1970-01-01").cast("date")
    for f, t in aggs:
        r = point_features(t.df, f.spec, df, key, time, prefilter=prefilter)
        r = r.select(*ks, F.date_add(epoch, F.col("__g").cast("int")).alias("__t"), *f.spec.names)
        base = r if base is None else base.join(r, on=ks + ["__t"], how="left")
        names += f.spec.names
    clash = [n for n in names if n in df.columns]
    if clash:
        raise ValueError(f"feature names already in the spine: {clash}")
    cond = [df[k] == base[kk] for k, kk in zip(key, ks)] + [df[time] == base["__t"]]
    out = df.join(base, cond[0] if len(cond) == 1 else _all(cond), "left")
    return out.select(*[df[c] for c in df.columns], *[base[n] for n in names])


def _all(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def training_set(spine: DataFrame, features: Sequence[Feature], tables: Mapping[str, object],
                 label: str | None = None, exclude: Sequence[str] = (), nulls: str = "keep",
                 defaults: Mapping[str, object] | None = None, label_type: str | None = "double",
                 asof_strategy: str = "union", override: bool = False,
                 materialize_spine: bool = False, prefilter=False, supplied: Sequence[str] = ()) -> DataFrame:
    """Spine + features + label, minus ``exclude`` (P10, names absent are ignored).

    ``defaults`` fills missing values per column (P13); ``nulls="drop"`` then
    drops rows with any remaining NULL in the kept columns (P12).
    ``materialize_spine`` writes a derived spine once to the shared checkpoint
    folder, so its several reads scan files instead of recomputing it. The label is cast to
    ``label_type`` (P6) and placed last.
    """
    if label is not None and label not in spine.columns:
        raise ValueError(f"label {label!r} not in spine")
    if materialize_spine:
        # the spine is read once per point-in-time group and once per re-attach:
        # a derived spine (joins, filters) is written once and read back as files
        spine = materialize(spine, name="spine")
    df, names = compile_features(spine, features, tables, override=override,
                                 asof_strategy=asof_strategy, prefilter=prefilter, supplied=supplied)
    if defaults:
        unknown = [k for k in defaults if k not in df.columns]
        if unknown:
            warnings.warn(f"defaults for unknown columns ignored: {unknown}", stacklevel=2)
        df = df.fillna({k: v for k, v in defaults.items() if k in df.columns})
    if nulls not in ("keep", "drop"):
        raise ValueError("nulls must be 'keep' or 'drop'")
    keep_spine = [c for c in spine.columns if c != label and c not in names]
    cols = keep_spine + [n for n in names if n not in keep_spine]
    drop = set(drop_existing(cols + ([label] if label else []), list(exclude)))
    out = [F.col(c) for c in cols if c not in drop]
    if label is not None and label not in drop:
        out.append(F.col(label).cast(label_type).alias(label) if label_type else F.col(label))
    res = df.select(*out)
    # like a dropna() of the finished frame: any NULL in any kept column drops the row
    return res.dropna(how="any") if nulls == "drop" else res


def apply_spec(spec: FeatureSpec, df: DataFrame, tables: Mapping[str, object],
               override: bool = True, asof_strategy: str = "union", prefilter=False,
               supplied: Sequence[str] = ()) -> DataFrame:
    """Apply a named feature spec to any frame carrying its lookup keys."""
    out, _ = compile_features(df, spec.features, tables, override=override,
                              asof_strategy=asof_strategy, prefilter=prefilter, supplied=supplied)
    return out


def attach(spine: DataFrame, aggregates: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """LEFT join of precomputed aggregates on spine columns -> aggregate columns.

    ``on`` maps spine column names to the aggregate table's names; the
    aggregate's key columns are dropped after the join.
    """
    right_keys = list(on.values())
    feats = [c for c in aggregates.columns if c not in right_keys]
    clash = [c for c in feats if c in spine.columns]
    if clash:
        raise ValueError(f"aggregate columns already in spine: {clash}")
    r = aggregates.select(*[F.col(k).alias(f"__ak{i}") for i, k in enumerate(right_keys)], *feats)
    cond = None
    for i, s in enumerate(on.keys()):
        c = spine[s] == r[f"__ak{i}"]
        cond = c if cond is None else cond & c
    return spine.join(r, cond, "left").select(*[spine[c] for c in spine.columns], *[r[f] for f in feats])
