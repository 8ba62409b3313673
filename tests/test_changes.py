"""Change feed with tombstones, ring-state windows, refreshed grids, table functions."""

import datetime as dt

from paths import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitfeat import Agg, AggregateSpec, Lookback
from pitfeat.operators import rolling as R
from pitfeat.operators.reshape import register_row_function
from pitfeat.streaming import changes as CH
from pitfeat.workloads import QUERIES

SCHEMA = "k long, part string, v double, w string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=str)


def states(spark):
    a = [(1, "a", 1.0, None), (1, "b", None, "x"), (2, "a", 3.0, "y"), (None, "a", 9.0, "no key")]
    b = [(1, "a", 1.0, None), (1, "b", 2.0, "x"), (3, "a", None, None)]
    c = [(1, "a", 1.0, "z"), (2, "a", 3.0, "y"), (3, "a", None, None)]
    return [spark.createDataFrame(x, SCHEMA) for x in (a, b, c)]


def test_differences_of_two_states(spark):
    a, b, _ = states(spark)
    assert rows(CH.snapshot_changes(a, b, ["k", "part"])) == sorted(
        [(1, "b", 2.0, "x", "upsert"), (2, "a", None, None, "delete"), (3, "a", None, None, "upsert")], key=str)
    assert CH.snapshot_changes(a, a, ["k", "part"]).count() == 0


def test_feed_is_replay_safe_and_loses_keys(spark, tmp_path):
    path, key = str(tmp_path / "feed"), ["k", "part"]
    for number, state in enumerate(states(spark)):
        for _ in range(2):  # every publication is run again
            CH.publish_snapshot(spark, state, key, path, number)
        assert rows(CH.read_snapshot(spark, path, key)) == rows(state.where("k IS NOT NULL"))
    a, b, c = states(spark)
    CH.publish_snapshot(spark, b, key, path, 1)  # an old one, after a later one was written
    assert rows(CH.read_snapshot(spark, path, key)) == rows(c)
    replica = a.where("k IS NOT NULL")
    for after, before, want in ((0, 2, b), (0, None, c), (5, None, a.where("k IS NOT NULL"))):
        assert rows(CH.apply_changes(replica, CH.read_changes(spark, path, after, before), key)) == rows(want)


def test_ring_equals_sliding_windows(spark):
    assert rows(QUERIES["stream_rolling_ring"](spark, SF_SMALL), "account_id", "window_start", "window_end", "amount_sum", "amount_count") == rows(
        QUERIES["stream_rolling"](spark, SF_SMALL), "account_id", "window_start", "window_end", "amount_sum", "amount_count")


def test_refreshed_grid_equals_a_new_one(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    early = [(1, day(3), 1.0), (1, day(9), 2.0), (2, day(5), 4.0), (4, day(1), 7.0)]
    late = [(1, day(4), 8.0), (3, day(2), 16.0), (2, day(12), 32.0), (None, day(3), 1.0), (1, None, 1.0)]
    schema = "k long, d date, x decimal(18,2)"
    frame = lambda r: spark.createDataFrame(r, "k long, d date, y double").selectExpr("k", "d", "CAST(y AS decimal(18,2)) AS x")
    assert frame(early).schema == spark.createDataFrame([], schema).schema
    spec = AggregateSpec("k", "d", [Agg("x", "sum", Lookback(3)), Agg("x", "count", Lookback(2, offset=-2))], start=day(0), end=None)
    old = R.aggregate_features(frame(early), spec, mode="grid")
    whole = frame(early + late)
    fresh = R.refresh_grid(old, whole, frame(late), spec)
    assert rows(fresh) == rows(R.aggregate_features(whole, spec, mode="grid"))
    # cells that no late fact reaches are kept as they were
    marked = old.withColumn("x_sum_3d", F.lit(-1.0))
    kept = R.refresh_grid(marked, whole, frame(late), spec).where("x_sum_3d = -1").select("k", "d")
    assert {(r["k"], r["d"]) for r in kept.collect()} >= {(4, day(i)) for i in range(10)} and kept.where("k = 3").count() == 0
    assert rows(R.refresh_grid(old, frame(early), frame([]), spec)) == rows(old)


def test_row_function_of_several_shapes(spark):
    def repeat(value, n):
        return [(value, i) for i in range(n or 0)]

    register_row_function(spark, "repeat_rows", repeat, lambda value, n: StructType().add("value", value.dataType).add("i", "integer"))
    spark.createDataFrame([("a", 2), ("b", 0), ("c", None)], "s string, n int").createOrReplaceTempView("repeat_input")
    got = spark.sql("SELECT t.s, f.* FROM repeat_input t, LATERAL repeat_rows(t.s, t.n) f")
    assert rows(got) == [("a", "a", 0), ("a", "a", 1)]
    numbers = spark.sql("SELECT f.* FROM repeat_input t, LATERAL repeat_rows(t.n, 1) f")
    assert numbers.schema["value"].dataType.simpleString() == "int" and rows(numbers) == sorted([(2, 0), (0, 0), (None, 0)], key=str)
