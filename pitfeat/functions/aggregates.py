"""Aggregate function registry (A6): each function in mergeable form.

Windowed aggregates are evaluated in two steps, so the sliding frame moves over
one row per (key, granule) instead of over raw facts:

* ``partials``: ordinary aggregates per (key, granule), map-side combined;
* ``merge``: a window aggregate of those partials over the frame.

Sums and counts of whole numbers (money as its unscaled long) are invertible: a
frame's value is the running value at its end less the one before its start, two
frames that only grow, so the cost of a row does not depend on the window's length.
Sketches, minima and maxima, and sums of floating numbers, slide.

Every merge yields the answer the raw-row aggregate would give over the same
frame (sum, count, min and max are exact; avg is ``double(sum) / count`` of the
exact decimal sum, unrounded).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def pname(kind: str, column: str) -> str:
    return f"__p_{kind}__{column}"


@dataclass(frozen=True)
class AggFunction:
    name: str
    # partial kind -> builder of the per-granule aggregate from the source column
    partials: dict[str, Callable[[Column], Column]]
    # (column name, window[, scale]) -> merged value
    merge: Callable[..., Column]
    empty: object = None  # value of an empty frame, before any user default
    result_type: str = "double"
    # True when ``merge`` takes ``scale``: the source may then be a decimal
    # carried as its unscaled long (exact, and faster in sliding frames)
    scaled: bool = False
    # (column name, upto, before[, scale]) -> merged value as a difference of two
    # running frames, for partials that are whole numbers; None where none exists
    differ: Callable[..., Column] | None = None
    # True when ``differ`` needs the column itself to be a whole number (an
    # unscaled decimal or an integer), not only its counts
    whole: bool = False


def _sum_p(c: Column) -> Column:
    return F.sum(c)


def _count_p(c: Column) -> Column:
    return F.count(c)


def _unscale(v: Column, scale: int) -> Column:
    # (double) unscaled / 10^scale: the very conversion of a compact decimal to double
    return v.cast("double") / F.lit(float(10 ** scale)) if scale else v


def _merge_sum(col: str, w: WindowSpec, scale: int = 0) -> Column:
    return _unscale(F.sum(pname("sum", col)).over(w), scale)


def _merge_count(col: str, w: WindowSpec, scale: int = 0) -> Column:
    # an empty frame sums to NULL; a count must be 0 there
    return F.coalesce(F.sum(pname("count", col)).over(w), F.lit(0).cast("bigint"))


def _merge_avg(col: str, w: WindowSpec, scale: int = 0) -> Column:
    s = _unscale(F.sum(pname("sum", col)).over(w), scale).cast("double")
    n = F.sum(pname("count", col)).over(w).cast("double")
    return F.when(n > 0, s / n)


def _merge_min(col: str, w: WindowSpec, scale: int = 0) -> Column:
    return _unscale(F.min(pname("min", col)).over(w), scale)


def _merge_max(col: str, w: WindowSpec, scale: int = 0) -> Column:
    return _unscale(F.max(pname("max", col)).over(w), scale)


def _active_p(c: Column) -> Column:
    # a granule counts as active when it holds a positive amount (H4, H5)
    return F.max(F.when(c > 0, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def _merge_active(col: str, w: WindowSpec, scale: int = 0) -> Column:
    return F.coalesce(F.sum(pname("active", col)).over(w), F.lit(0).cast("bigint"))


def _hll_p(c: Column) -> Column:
    # HLL sketches merge across granules, so distinct counts stay mergeable (A5)
    return F.hll_sketch_agg(c)


def _merge_hll(col: str, w: WindowSpec, scale: int = 0) -> Column:
    est = F.hll_sketch_estimate(F.hll_union_agg(pname("hll", col)).over(w))
    return F.coalesce(est, F.lit(0).cast("bigint"))


def _running(f: Callable[[str], Column], partial: str, upto: WindowSpec, before: WindowSpec) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(f(partial).over(upto), zero) - F.coalesce(f(partial).over(before), zero)


def _differ_sum(col: str, upto: WindowSpec, before: WindowSpec, scale: int = 0) -> Column:
    p = pname("sum", col)  # NULL where the granule has no value
    return F.when(_running(F.count, p, upto, before) > 0, _unscale(_running(F.sum, p, upto, before), scale))


def _differ_count(col: str, upto: WindowSpec, before: WindowSpec, scale: int = 0) -> Column:
    return _running(F.sum, pname("count", col), upto, before)


def _differ_avg(col: str, upto: WindowSpec, before: WindowSpec, scale: int = 0) -> Column:
    n = _running(F.sum, pname("count", col), upto, before).cast("double")
    return F.when(n > 0, _unscale(_running(F.sum, pname("sum", col), upto, before), scale).cast("double") / n)


def _differ_active(col: str, upto: WindowSpec, before: WindowSpec, scale: int = 0) -> Column:
    return _running(F.sum, pname("active", col), upto, before)


REGISTRY: dict[str, AggFunction] = {
    "sum": AggFunction("sum", {"sum": _sum_p}, _merge_sum, scaled=True, differ=_differ_sum, whole=True),
    "count": AggFunction("count", {"count": _count_p}, _merge_count, 0, "bigint", scaled=True, differ=_differ_count),
    "avg": AggFunction("avg", {"sum": _sum_p, "count": _count_p}, _merge_avg, scaled=True, differ=_differ_avg, whole=True),
    "min": AggFunction("min", {"min": F.min}, _merge_min, scaled=True),
    "max": AggFunction("max", {"max": F.max}, _merge_max, scaled=True),
    "active_days": AggFunction("active_days", {"active": _active_p}, _merge_active, 0, "bigint",
                               scaled=True, differ=_differ_active),
    "approx_count_distinct": AggFunction(
        "approx_count_distinct", {"hll": _hll_p}, _merge_hll, 0, "bigint", scaled=True),
}
ALIASES = {"mean": "avg", "approx_distinct": "approx_count_distinct",
           "transaction_days": "active_days"}


def get(name: str | object) -> AggFunction:
    """Look a function up by short name, alias, or an object with ``.name``."""
    key = name if isinstance(name, str) else getattr(name, "name", None)
    if key is None:
        raise KeyError(f"unknown aggregate function {name!r}")
    key = key.lower()
    key = ALIASES.get(key, key)
    if key not in REGISTRY:
        raise KeyError(f"unknown aggregate function {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[key]


def register(fn: AggFunction) -> None:
    REGISTRY[fn.name] = fn
