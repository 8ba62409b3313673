"""Declarative feature specs: plain frozen dataclasses, no Spark needed.

The operators in ``pitfeat.operators`` and ``pitfeat.plans`` compile these into
lazy DataFrames. Every spec can be validated against a schema and round-trips
through JSON, so a feature spec can be stored next to a model.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import json
import warnings
from dataclasses import asdict, dataclass, field
from typing import Any, Callable, Sequence

DAY = _dt.timedelta(days=1)


def _as_td(v: Any) -> _dt.timedelta:
    if isinstance(v, _dt.timedelta):
        return v
    if isinstance(v, (int, float)):
        return _dt.timedelta(days=v)
    raise TypeError(f"expected timedelta or a number of days, got {v!r}")


def _listify(v: str | Sequence[str] | None) -> tuple[str, ...]:
    if v is None:
        return ()
    if isinstance(v, str):
        return (v,)
    return tuple(v)


@dataclass(frozen=True)
class TableSpec:
    """Key declaration of a table: ``key`` columns plus an optional time key.

    ``PRIMARY KEY(k, t TIMESERIES)`` becomes ``TableSpec(key=["k"], time_key="t")``.
    Parquet tables cannot enforce it; ``operators.quality`` validates it.
    """

    key: tuple[str, ...]
    time_key: str | None = None
    not_null: tuple[str, ...] = ()

    def __init__(self, key, time_key=None, not_null=()):
        object.__setattr__(self, "key", _listify(key))
        object.__setattr__(self, "time_key", time_key)
        object.__setattr__(self, "not_null", _listify(not_null))

    @property
    def primary_key(self) -> tuple[str, ...]:
        return self.key + ((self.time_key,) if self.time_key else ())

    def validate(self, columns: Sequence[str]) -> None:
        missing = [c for c in self.primary_key + self.not_null if c not in columns]
        if missing:
            raise ValueError(f"TableSpec columns not in schema: {missing}")


@dataclass(frozen=True)
class Lookback:
    """A window of ``duration`` ending ``offset`` before the evaluation time.

    ``closed="right"`` (default) covers ``(t - offset - duration, t - offset]``:
    the current granule is included, as in the reference's dense rollups (H3).
    ``closed="left"`` ends one granule earlier, so the row being scored never
    sees its own day.  ``offset`` is given as a positive look-back amount; a
    negative value (the reference's ``offset=-timedelta(days=2)``) is accepted
    and means the same.
    """

    duration: _dt.timedelta
    offset: _dt.timedelta = _dt.timedelta(0)
    closed: str = "right"

    def __init__(self, duration, offset=_dt.timedelta(0), closed="right"):
        d, o = _as_td(duration), abs(_as_td(offset))
        if d <= _dt.timedelta(0):
            raise ValueError("duration must be positive")
        if closed not in ("right", "left"):
            raise ValueError("closed must be 'right' or 'left'")
        object.__setattr__(self, "duration", d)
        object.__setattr__(self, "offset", o)
        object.__setattr__(self, "closed", closed)

    def granules(self, granularity: _dt.timedelta = DAY) -> tuple[int, int]:
        d, rd = divmod(self.duration, granularity)
        o, ro = divmod(self.offset, granularity)
        if rd or ro:
            raise ValueError(f"{self} is not a whole number of {granularity}")
        return int(d), int(o)

    def frame(self, granularity: _dt.timedelta = DAY) -> tuple[int, int]:
        """Inclusive (lo, hi) frame bounds in granules relative to the current one."""
        d, o = self.granules(granularity)
        if self.closed == "right":
            return -(o + d - 1), -o
        return -(o + d), -(o + 1)

    def suffix(self, granularity: _dt.timedelta = DAY) -> str:
        d, o = self.granules(granularity)
        units = {DAY: "d", _dt.timedelta(hours=1): "h", _dt.timedelta(minutes=1): "m",
                 _dt.timedelta(seconds=1): "s"}
        unit = units.get(granularity, "g")
        s = f"{d}{unit}"
        if o:
            s += f"_offset_{o}{unit}"
        if self.closed == "left":
            s += "_excl"
        return s


@dataclass(frozen=True)
class Agg:
    """One windowed aggregate: ``fn`` of ``column`` over ``window``.

    ``fn`` is a short name from ``pitfeat.functions.aggregates.REGISTRY``
    (sum, avg, count, min, max, active_days, approx_count_distinct).
    ``default`` replaces the value of an empty window (H7); ``digits`` rounds
    the result half up to so many decimals (F6).
    """

    column: str
    fn: str
    window: Lookback
    default: Any = None
    name: str | None = None
    digits: int | None = None

    def output_name(self, granularity: _dt.timedelta = DAY) -> str:
        return self.name or f"{self.column}_{self.fn}_{self.window.suffix(granularity)}"


@dataclass(frozen=True)
class AggregateSpec:
    """Windowed aggregates of one source: key, time column, bounds, granularity.

    ``start``/``end`` bound the dense grid (``mode="grid"``); ``end=None`` means
    the latest time present in the source, never the wall clock (H17, H19).
    """

    key: tuple[str, ...]
    time: str
    aggs: tuple[Agg, ...]
    start: Any = None
    end: Any = None
    granularity: _dt.timedelta = DAY
    source: str | None = None  # optional name of the facts table (resolved by a client)

    def __init__(self, key, time, aggs, start=None, end=None, granularity=DAY, source=None):
        object.__setattr__(self, "source", source)
        object.__setattr__(self, "key", _listify(key))
        object.__setattr__(self, "time", time)
        object.__setattr__(self, "aggs", tuple(aggs))
        object.__setattr__(self, "start", start)
        object.__setattr__(self, "end", end)
        g = _as_td(granularity)
        if g <= _dt.timedelta(0) or (g >= DAY and g % DAY) or (g < DAY and DAY % g):
            raise ValueError("granularity must be whole days or divide a day")
        object.__setattr__(self, "granularity", g)
        names = [a.output_name(g) for a in self.aggs]
        dup = sorted({n for n in names if names.count(n) > 1})
        if dup:
            raise ValueError(f"duplicate aggregate names: {dup}")
        for a in self.aggs:
            a.window.frame(g)

    @property
    def names(self) -> list[str]:
        return [a.output_name(self.granularity) for a in self.aggs]

    @property
    def max_span(self) -> int:
        """Largest distance back, in granules, any aggregate reaches."""
        return max(-a.window.frame(self.granularity)[0] for a in self.aggs)


#: What a search-space entry may hold: required lists first, then options and their defaults.
SEARCH_REQUIRED = ("window", "function")
SEARCH_OPTIONS = {"offset": (0,), "closed": ("right",), "default": (None,)}


def expand_search_space(space: Sequence[dict]) -> list[Agg]:
    """Every combination of an entry's windows, offsets, closed sides, defaults and functions.

    Scalars count as lists of one; what is left out takes its default, so every
    entry goes the same way. Unknown or empty parts raise an error that names them.
    """
    def choices(entry: dict, part: str) -> list:
        v = entry.get(part, SEARCH_OPTIONS.get(part, ()))
        return list(v) if isinstance(v, (list, tuple)) else [v]

    def of(entry: dict) -> list[Agg]:
        axes = [SEARCH_REQUIRED[0], *SEARCH_OPTIONS, SEARCH_REQUIRED[1]]
        unknown = sorted(set(entry) - {"column", *axes})
        lacking = [p for p in ("column", *axes) if p != "column" and not choices(entry, p)] + ["column"] * ("column" not in entry)
        if unknown or lacking:
            raise ValueError(f"search-space entry {entry}: unknown {unknown}, missing or empty {lacking}")
        return [Agg(entry["column"], fn, Lookback(length, offset=offset, closed=side), default)
                for length, offset, side, default, fn in itertools.product(*(choices(entry, p) for p in axes))]

    return [agg for entry in space for agg in of(entry)]


@dataclass(frozen=True)
class FeatureLookup:
    """Features of ``table`` fetched by ``lookup_key`` (matched by position to
    the table's key, H10); with ``time_key`` the fetch is as-of that time.

    ``table`` names an entry of the ``tables`` mapping given at compile time;
    the mapping carries the DataFrame and its ``TableSpec``.
    """

    table: str
    features: tuple[str, ...]
    lookup_key: tuple[str, ...]
    time_key: str | None = None
    rename: tuple[tuple[str, str], ...] = ()
    strict: bool = False  # as-of rows strictly before the observation time (H3)

    def __init__(self, table, features, lookup_key, time_key=None, rename=None, strict=False):
        object.__setattr__(self, "table", table)
        object.__setattr__(self, "features", _listify(features))
        object.__setattr__(self, "lookup_key", _listify(lookup_key))
        object.__setattr__(self, "time_key", time_key)
        object.__setattr__(self, "rename", tuple(sorted((rename or {}).items())))
        object.__setattr__(self, "strict", bool(strict))

    def output_names(self) -> list[str]:
        r = dict(self.rename)
        return [r.get(f, f) for f in self.features]


@dataclass(frozen=True)
class FeatureFunction:
    """Bind a function to columns and name its output.

    ``fn`` is the name of a SQL function (temporary or built in) called with the
    bound columns in ``bindings`` order, or a Python callable taking Columns and
    returning a Column.
    """

    fn: str | Callable
    bindings: tuple[tuple[str, str], ...]
    output: str

    def __init__(self, fn, bindings, output):
        object.__setattr__(self, "fn", fn)
        items = bindings.items() if isinstance(bindings, dict) else bindings
        object.__setattr__(self, "bindings", tuple(items))
        object.__setattr__(self, "output", output)

    def output_names(self) -> list[str]:
        return [self.output]


@dataclass(frozen=True)
class FeatureAggregation:
    """Windowed aggregates of the facts table ``table`` evaluated at each spine
    row: ``lookup_key`` spine columns match ``spec.key`` by position and
    ``time_key`` is the spine's observation time."""

    table: str
    spec: AggregateSpec
    lookup_key: tuple[str, ...]
    time_key: str

    def __init__(self, table, spec, lookup_key, time_key):
        object.__setattr__(self, "table", table)
        object.__setattr__(self, "spec", spec)
        object.__setattr__(self, "lookup_key", _listify(lookup_key))
        object.__setattr__(self, "time_key", time_key)
        if len(self.lookup_key) != len(spec.key):
            raise ValueError("lookup_key and the aggregate spec's key differ in length")

    def output_names(self) -> list[str]:
        return self.spec.names


def _td_seconds(v) -> float | None:
    return None if v is None else v.total_seconds()


def aggregate_spec_to_dict(spec: AggregateSpec) -> dict:
    def bound(v):
        return None if v is None else (v.isoformat() if hasattr(v, "isoformat") else str(v))
    return {"key": list(spec.key), "time": spec.time, "granularity_s": _td_seconds(spec.granularity),
            "source": spec.source,
            "start": bound(spec.start), "end": bound(spec.end),
            "aggs": [{"column": a.column, "fn": a.fn, "duration_s": _td_seconds(a.window.duration),
                      "offset_s": _td_seconds(a.window.offset), "closed": a.window.closed,
                      "default": a.default, "name": a.name} for a in spec.aggs]}


def aggregate_spec_from_dict(d: dict) -> AggregateSpec:
    aggs = [Agg(a["column"], a["fn"], Lookback(_dt.timedelta(seconds=a["duration_s"]),
                                               offset=_dt.timedelta(seconds=a["offset_s"]), closed=a["closed"]),
                default=a["default"], name=a["name"]) for a in d["aggs"]]
    return AggregateSpec(d["key"], d["time"], aggs, start=d["start"], end=d["end"],
                         granularity=_dt.timedelta(seconds=d["granularity_s"]), source=d.get("source"))


Feature = FeatureLookup | FeatureFunction | FeatureAggregation


@dataclass(frozen=True)
class FeatureSpec:
    """A named, reusable list of lookups and functions (T5)."""

    name: str
    features: tuple[Feature, ...] = field(default_factory=tuple)

    def __init__(self, name, features):
        object.__setattr__(self, "name", name)
        object.__setattr__(self, "features", tuple(features))

    def output_names(self) -> list[str]:
        return [n for f in self.features for n in f.output_names()]

    def apply(self, df, tables, override: bool = True, asof_strategy: str = "union"):
        """Attach this spec's features to ``df`` (see ``plans.training.apply_spec``)."""
        from .plans.training import apply_spec
        return apply_spec(self, df, tables, override=override, asof_strategy=asof_strategy)

    def to_json(self) -> str:
        items = []
        for f in self.features:
            if isinstance(f, FeatureLookup):
                d = asdict(f)
                d["rename"] = dict(f.rename)
                items.append({"kind": "lookup", **d})
            elif isinstance(f, FeatureAggregation):
                items.append({"kind": "aggregation", "table": f.table, "lookup_key": list(f.lookup_key),
                              "time_key": f.time_key, "spec": aggregate_spec_to_dict(f.spec)})
            else:
                if callable(f.fn):
                    raise ValueError("only SQL-named functions serialise to JSON")
                items.append({"kind": "function", "fn": f.fn,
                              "bindings": dict(f.bindings), "output": f.output})
        return json.dumps({"name": self.name, "features": items}, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FeatureSpec":
        raw = json.loads(text)
        feats: list[Feature] = []
        for it in raw["features"]:
            kind = it.pop("kind")
            if kind == "lookup":
                feats.append(FeatureLookup(**it))
            elif kind == "aggregation":
                feats.append(FeatureAggregation(it["table"], aggregate_spec_from_dict(it["spec"]),
                                                it["lookup_key"], it["time_key"]))
            else:
                feats.append(FeatureFunction(it["fn"], it["bindings"], it["output"]))
        return cls(raw["name"], feats)


def check_columns(where: str, wanted: Sequence[str], columns: Sequence[str]) -> None:
    missing = [c for c in wanted if c not in columns]
    if missing:
        raise ValueError(f"{where}: columns {missing} not in {list(columns)}")


def drop_existing(columns: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """Names of ``exclude`` present in ``columns``; warns about the rest."""
    absent = [c for c in exclude if c not in columns]
    if absent:
        warnings.warn(f"exclude names not present, ignored: {absent}", stacklevel=3)
    return [c for c in exclude if c in columns]
