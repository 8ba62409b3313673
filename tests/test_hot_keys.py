"""Time buckets cut by row count, chunked lookups, range joins by spans, running windows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat import Agg, AggregateSpec, Lookback
from pitfeat.operators import lookup as L
from pitfeat.operators import rolling as R
from pitfeat.operators import scd as S
from pitfeat.operators.buckets import time_buckets

DAY = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def changes(spark):
    """Key 1 has a third of the rows, most on one day; ties of time among them."""
    r = np.random.default_rng(5)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else int(r.integers(2, 40))
        seconds = int(r.integers(0, 86_400)) if key == 1 and i % 10 else int(r.integers(0, 20 * 86_400))
        rows.append((key, DAY + dt.timedelta(seconds=seconds // 60 * 60), i, i % 7))
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, id long, v long").cache()


def test_buckets_are_bounded_and_ordered(changes):
    got = time_buckets(changes, ["k"], "t", dt.timedelta(days=1), hot_rows=100, splits=32).collect()
    assert len(got) == 3000
    by = {}
    for r in got:
        by.setdefault((r["k"], r["__b"]), []).append(r["t"])
    assert max(map(len, by.values())) <= 100
    plain = time_buckets(changes, ["k"], "t", dt.timedelta(days=1), hot_rows=None).groupBy("k", "__b").count().agg(F.max("count")).first()[0]
    assert plain > 800
    for key in {k for k, _ in by}:
        spans = sorted((b, min(ts), max(ts)) for (k, b), ts in by.items() if k == key)
        assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))  # in time order, an instant in one bucket
    with pytest.raises(ValueError):
        time_buckets(changes, ["k"], "t", dt.timedelta(days=1), splits=0)


def test_versions_of_a_hot_key(changes):
    cold = S.build_scd2(changes, "k", "t", ["id", "v"], order_by=["id"], hot_rows=None)
    hot = S.build_scd2(changes, "k", "t", ["id", "v"], order_by=["id"], hot_rows=60)
    assert sorted(map(tuple, hot.collect()), key=str) == sorted(map(tuple, cold.collect()), key=str)


@pytest.mark.parametrize("strict", [False, True])
def test_lookups_of_a_hot_key(spark, changes, strict):
    spine = changes.select("k", F.expr("t + interval 30 seconds * (id % 3)").alias("at"), F.col("id").alias("row"))
    spine = spine.union(spark.createDataFrame([(1, DAY - dt.timedelta(days=1), -1), (None, DAY, -2), (77, DAY, -3), (1, None, -4)], "k long, at timestamp_ntz, row long"))
    right = L.AsOfRight(changes, ["k"], "t", ["v", "id"], order_by=[F.col("id")], strict=strict)
    versions = {}
    for c in changes.collect():
        versions.setdefault(c["k"], []).append((c["t"], c["id"], c["v"]))
    want = set()
    for s in spine.collect():
        seen = [x for x in versions.get(s["k"], []) if s["at"] is not None and (x[0] < s["at"] or x[0] == s["at"] and not strict)]
        best = max(seen, default=(None, None, None))
        want.add((s["k"], s["at"], s["row"], best[2], best[1]))
    for got in (L.lookup_asof(spine, [right], "k", "at", hot_rows=50), L.lookup_asof(spine, [right], "k", "at", hot_rows=None),
                L.lookup_asof(spine, [right], "k", "at", strategy="packed"),
                L._asof_chunks(spine, right, ["k"], "at", 0, hot_rows=80, chunk=5, fan=4)):
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == 3004 and set(rows) == want


def test_no_chunk_holds_a_whole_history(changes):
    """The longest array of the windowless plan is the chunk, not the key's history."""
    spine = changes.select("k", F.col("t").alias("at"))
    right = L.AsOfRight(changes, ["k"], "t", ["v"], order_by=[F.col("id")])
    plan = L._asof_chunks(spine, right, ["k"], "at", 0, hot_rows=80, chunk=5, fan=4)
    assert changes.where("k = 1").select("t").distinct().count() > 500 and plan.count() == 3000


def test_overlapping_versions_by_spans(spark):
    r = np.random.default_rng(9)
    rows = []
    for i in range(500):
        start = int(r.integers(0, 100_000))
        length = [0, 1, 10, 3000, 90_000][i % 5]
        rows.append((i % 4, DAY + dt.timedelta(seconds=start), None if i % 50 == 7 else DAY + dt.timedelta(seconds=start + length), i))
    rows += [(None, DAY, None, -1), (1, None, DAY, -2), (1, DAY, DAY - dt.timedelta(days=1), -3)]
    right = spark.createDataFrame(rows, "k long, a timestamp_ntz, b timestamp_ntz, v long")
    points = [(i % 5, DAY + dt.timedelta(seconds=int(r.integers(-10, 200_000)), microseconds=int(r.integers(0, 10 ** 6)))) for i in range(300)]
    points += points[:3] + [(None, DAY), (1, None)]
    spine = spark.createDataFrame(points, "key long, t timestamp_ntz")
    want = []
    for k, t in points:
        hits = [v for kk, a, b, v in rows if None not in (k, t, kk, a) and kk == k and a <= t and (b is None or t < b)]
        want += [(k, t, v) for v in hits] or [(k, t, None)]
    got = L.lookup_interval(spine, right, "key", "k", "t", "a", "b", ["v"], strategy="join")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 600
    days = right.selectExpr("k", "to_date(a) AS a", "to_date(b) AS b", "v")
    spine = spine.selectExpr("key", "to_date(t) AS t")
    plain = spine.join(days, (F.col("key") == F.col("k")) & (F.col("a") <= F.col("t")) & (F.col("b").isNull() | (F.col("t") < F.col("b"))), "left").select("key", "t", "v")
    got = L.lookup_interval(spine, days, "key", "k", "t", "a", "b", ["v"], strategy="join")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_running_windows_equal_sliding_ones(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(int(r.integers(0, 5)), dt.date(2020, 1, 1) + dt.timedelta(days=int(r.integers(0, 1500))), None if i % 9 == 0 else float(r.integers(-500, 500)) / 100) for i in range(1500)]
    facts = spark.createDataFrame(rows, "k long, d date, x double").withColumn("m", F.col("x").cast("decimal(18,2)"))
    aggs = [Agg(c, f, Lookback(n, offset=o, closed=s), name=f"{c}_{f}_{n}_{-o}_{s}") for c in ("m", "x") for f in ("sum", "avg", "count", "active_days")
            for n, o, s in ((3, 0, "right"), (200, 0, "right"), (40, -10, "right"), (365, 0, "left"))]
    spec = AggregateSpec("k", "d", aggs)
    spine = spark.createDataFrame([(k, dt.date(2020, 1, 1) + dt.timedelta(days=7 * i)) for k in range(6) for i in range(0, 230, 3)], "k long, d date")
    results = []
    for least in (1, 32, 10 ** 6):
        monkeypatch.setattr(R, "LONG_WINDOW", least)
        for mode in ({"mode": "facts"}, {"spine": spine}):
            results.append(sorted(map(tuple, R.aggregate_features(facts, spec, bucket_width=400, **mode).collect()), key=str))
    assert results[0] == results[2] == results[4] and results[1] == results[3] == results[5]
    assert any(None in row for row in results[1])
