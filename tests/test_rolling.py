"""Windowed aggregates on tiny frames (FIXTURES part 3) and against brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pitfeat.operators import rolling as R
from pitfeat.specs import Agg, AggregateSpec, Lookback

D0 = dt.date(2024, 1, 1)
FACT_SCHEMA = "k bigint, t date, amount decimal(18,2)"
SPINE_SCHEMA = "id bigint, k bigint, t date"


def day(n):
    return D0 + dt.timedelta(days=n)


def facts(spark, rows):
    return spark.createDataFrame([(k, day(d), Decimal(a) if a is not None else None) for k, d, a in rows],
                                 FACT_SCHEMA)


def spine(spark, rows):
    return spark.createDataFrame([(i, k, day(d) if d is not None else None) for i, k, d in rows], SPINE_SCHEMA)


def brute(fact_rows, k, p, fn, d, o=0, closed="right"):
    lo, hi = (p - o - d + 1, p - o) if closed == "right" else (p - o - d, p - o - 1)
    vals = [Decimal(a) for kk, dd, a in fact_rows if kk == k and lo <= dd <= hi and a is not None]
    if fn == "sum":
        return float(sum(vals)) if vals else None
    if fn == "count":
        return len(vals)
    if fn == "avg":
        return float(sum(vals)) / len(vals) if vals else None
    if fn == "active_days":
        return len({dd for kk, dd, a in fact_rows if kk == k and lo <= dd <= hi and a is not None
                    and Decimal(a) > 0})
    raise ValueError(fn)


GAP_FACTS = [(1, 1, "10.00"), (1, 8, "20.00"), (1, 15, "40.00")]


@pytest.mark.parametrize("width", [None, 3, 5])
def test_gap_days_frame_edges(spark, width):
    """Facts on days 1, 8, 15: edges of 7/14-day frames and offsets 5 and 10."""
    aggs = [Agg("amount", "sum", Lookback(7)), Agg("amount", "sum", Lookback(14)),
            Agg("amount", "sum", Lookback(5, offset=5)), Agg("amount", "sum", Lookback(5, offset=10)),
            Agg("amount", "count", Lookback(7, closed="left")), Agg("amount", "avg", Lookback(14))]
    spec = AggregateSpec("k", "t", aggs)
    sp = [(i, 1, p) for i, p in enumerate(range(0, 30))]
    out = R.aggregate_features(facts(spark, GAP_FACTS), spec, spine=spine(spark, sp), bucket_width=width)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 30
    for i, k, p in sp:
        for a in aggs:
            d, o = a.window.granules()
            want = brute(GAP_FACTS, k, p, a.fn, d, o, a.window.closed)
            assert got[i][a.output_name()] == want, (p, a.output_name())


def test_same_day_pair_and_closed_left(spark):
    """Two facts on one day plus a spine row that day: peers are included (H3)."""
    f = facts(spark, [(1, 3, "5.00"), (1, 3, "7.50")])
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)),
                                    Agg("amount", "sum", Lookback(7, closed="left")),
                                    Agg("amount", "count", Lookback(7))])
    r = R.aggregate_features(f, spec, spine=spine(spark, [(0, 1, 3)])).collect()[0]
    assert r["amount_sum_7d"] == 12.5
    assert r["amount_sum_7d_excl"] is None
    assert r["amount_count_7d"] == 2


def test_duplicate_spine_rows_survive(spark):
    f = facts(spark, [(1, 1, "1.00")])
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7))])
    out = R.aggregate_features(f, spec, spine=spine(spark, [(0, 1, 2), (0, 1, 2)]))
    assert [r["amount_sum_7d"] for r in out.collect()] == [1.0, 1.0]


def test_dangling_null_key_null_time(spark):
    """Key absent from facts, NULL key, NULL time: NULL features, counts 0, rows kept."""
    f = facts(spark, [(1, 1, "1.00")])
    sp = spark.createDataFrame([(0, 2, day(1)), (1, None, day(1)), (2, 1, None), (3, 1, day(1))],
                               SPINE_SCHEMA)
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "count", Lookback(7))])
    got = {r["id"]: r for r in R.aggregate_features(f, spec, spine=sp).collect()}
    assert len(got) == 4
    assert got[0]["amount_sum_7d"] is None and got[0]["amount_count_7d"] == 0
    assert got[1]["amount_sum_7d"] is None and got[1]["amount_count_7d"] is None
    assert got[2]["amount_sum_7d"] is None
    assert got[3]["amount_sum_7d"] == 1.0


def test_three_versions_do_not_multiply(spark):
    """H1: an entity with 3 SCD-2 versions must not triple the dense sums."""
    f = facts(spark, [(1, 2, "3.00"), (1, 2, "4.00")])
    ents = spark.createDataFrame([(1, day(0)), (1, day(1)), (1, day(2))], "k bigint, valid_from date")
    spec = R.rolling_7_14_spec("k", "t", "amount")
    out = R.dense_daily(f, spec, entities=ents, start_col="valid_from").orderBy("t").collect()
    assert [r["t"] for r in out] == [day(0), day(1), day(2)]
    assert [r["7_day_total"] for r in out] == [0.0, 0.0, 7.0]
    assert [r["7_day_transaction_count"] for r in out] == [0, 0, 1]


def test_random_against_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(1, 4), rnd.randint(0, 60), f"{rnd.randint(-500, 5000) / 100:.2f}") for _ in range(300)]
    rows += [(2, 10, None)]
    sp = [(i, rnd.randint(1, 5), rnd.randint(-5, 70)) for i in range(200)]
    aggs = [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(10, offset=3)),
            Agg("amount", "count", Lookback(4, closed="left")), Agg("amount", "active_days", Lookback(9))]
    spec = AggregateSpec("k", "t", aggs)
    for width in (None, 2, 7):
        got = {r["id"]: r for r in R.aggregate_features(facts(spark, rows), spec, spine=spine(spark, sp),
                                                        bucket_width=width).collect()}
        for i, k, p in sp:
            for a in aggs:
                d, o = a.window.granules()
                want = brute(rows, k, p, a.fn, d, o, a.window.closed)
                have = got[i][a.output_name()]
                if isinstance(want, float):
                    assert have == pytest.approx(want, rel=1e-12), (width, i, a.output_name())
                else:
                    assert have == want, (width, i, a.output_name())


def test_grid_equals_spine_at_shared_points(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 3), rnd.randint(0, 40), f"{rnd.randint(1, 900) / 10:.2f}") for _ in range(120)]
    f = facts(spark, rows)
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(5, offset=2))],
                         start=day(0), end=day(45))
    grid = {(r["k"], r["t"]): r for r in R.aggregate_features(f, spec, mode="grid", bucket_width=4).collect()}
    assert len(grid) == 3 * 46
    sp = spine(spark, [(i, k, d) for i, (k, d) in enumerate((k, d) for k in (1, 2, 3) for d in range(0, 46, 3))])
    for r in R.aggregate_features(f, spec, spine=sp).collect():
        g = grid[(r["k"], r["t"])]
        assert g["amount_sum_7d"] == r["amount_sum_7d"]
        assert g["amount_avg_5d_offset_2d"] == r["amount_avg_5d_offset_2d"]


def test_one_window_one_sort_for_many_features(spark):
    f = facts(spark, GAP_FACTS)
    spec = AggregateSpec("k", "t", [Agg("amount", fn, Lookback(d)) for fn in ("sum", "avg", "count")
                                    for d in (3, 7, 14, 30)])
    plan = R.aggregate_features(f, spec, mode="facts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    assert "Python" not in plan and "ArrowEval" not in plan


def test_approx_distinct_mergeable(spark):
    f = spark.createDataFrame([(1, day(d), m) for d, m in [(0, 10), (1, 11), (1, 10), (5, 12), (20, 13)]],
                              "k bigint, t date, m bigint")
    spec = AggregateSpec("k", "t", [Agg("m", "approx_count_distinct", Lookback(7))])
    got = {r["t"]: r["m_approx_count_distinct_7d"] for r in R.aggregate_features(f, spec, mode="facts").collect()}
    assert got[day(0)] == 1 and got[day(1)] == 2 and got[day(5)] == 3 and got[day(20)] == 1


def test_later_facts_never_change_earlier_answers(spark):
    rnd = random.Random(9)
    base = [(rnd.randint(1, 3), rnd.randint(0, 30), f"{rnd.randint(1, 999) / 10:.2f}") for _ in range(80)]
    later = [(rnd.randint(1, 3), rnd.randint(31, 60), f"{rnd.randint(1, 999) / 10:.2f}") for _ in range(80)]
    sp = spine(spark, [(i, rnd.randint(1, 3), rnd.randint(0, 30)) for i in range(50)])
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(10, offset=2))])
    a = sorted(tuple(r) for r in R.aggregate_features(facts(spark, base), spec, spine=sp).collect())
    b = sorted(tuple(r) for r in R.aggregate_features(facts(spark, base + later), spec, spine=sp).collect())
    assert a == b


def test_hourly_granularity_against_brute_force(spark):
    hour = dt.timedelta(hours=1)
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(4)
    rows = [(rnd.randint(1, 2), t0 + dt.timedelta(minutes=rnd.randint(0, 3000)), float(rnd.randint(1, 50)))
            for _ in range(200)]
    f = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double")
    pts = [(i, rnd.randint(1, 2), t0 + dt.timedelta(minutes=rnd.randint(0, 3100))) for i in range(60)]
    sp = spark.createDataFrame(pts, "id bigint, k bigint, ts timestamp_ntz")
    spec = AggregateSpec("k", "ts", [Agg("v", "sum", Lookback(3 * hour)), Agg("v", "count", Lookback(2 * hour, offset=hour))],
                         granularity=hour)
    got = {r["id"]: r for r in R.aggregate_features(f, spec, spine=sp, bucket_width=5).collect()}

    def hnum(x):
        return int((x - dt.datetime(1970, 1, 1)).total_seconds() // 3600)

    for i, k, ts in pts:
        p = hnum(ts)
        s3 = [v for kk, tt, v in rows if kk == k and p - 2 <= hnum(tt) <= p]
        c2 = [v for kk, tt, v in rows if kk == k and p - 2 <= hnum(tt) <= p - 1]
        assert got[i]["v_sum_3h"] == (sum(s3) if s3 else None)
        assert got[i]["v_count_2h_offset_1h"] == len(c2)


@pytest.mark.parametrize("width", [None, 2, 3, 8])
def test_grid_runs_against_brute_force_every_cell(spark, width):
    rnd = random.Random(21)
    rows = [(rnd.randint(1, 3), rnd.randint(0, 50), f"{rnd.randint(-100, 900) / 10:.2f}") for _ in range(90)]
    ents = spark.createDataFrame([(1, day(3)), (1, day(9)), (2, day(0)), (3, day(44)), (4, day(10))],
                                 "k bigint, since date")
    aggs = [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(5, offset=3)),
            Agg("amount", "count", Lookback(4, closed="left")), Agg("amount", "active_days", Lookback(6)),
            Agg("amount", "sum", Lookback(3), default=0)]
    spec = AggregateSpec("k", "t", aggs, end=day(55))
    out = R.aggregate_features(facts(spark, rows), spec, mode="grid", entities=ents, start_col="since",
                               bucket_width=width).collect()
    starts = {1: 3, 2: 0, 3: 44, 4: 10}
    want_cells = {(k, p) for k, s0 in starts.items() for p in range(s0, 56)}
    got = {(r["k"], (r["t"] - D0).days): r for r in out}
    assert set(got) == want_cells and len(out) == len(want_cells)
    for (k, p), r in got.items():
        for a in aggs:
            d, o = a.window.granules()
            want = brute(rows, k, p, a.fn, d, o, a.window.closed)
            if want is None and a.default is not None:
                want = float(a.default)
            have = r[a.output_name()]
            if isinstance(want, float) and have is not None:
                assert have == pytest.approx(want, rel=1e-12), (k, p, a.output_name())
            else:
                assert have == want, (k, p, a.output_name())


def test_hourly_ntz_results_do_not_depend_on_session_time_zone(spark):
    hour = dt.timedelta(hours=1)
    t0 = dt.datetime(2024, 3, 9, 20)  # spans a daylight-saving change in US zones
    rows = [(1, t0 + dt.timedelta(minutes=37 * i), float(i)) for i in range(60)]
    f = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double")
    spec = AggregateSpec("k", "ts", [Agg("v", "sum", Lookback(4 * hour))], granularity=hour)
    results = []
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            results.append(sorted(tuple(r) for r in R.aggregate_features(f, spec, mode="facts").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] == results[2]
    assert results[0][0][1] == t0


def test_feature_name_clash_with_spine_is_an_error(spark):
    f = facts(spark, GAP_FACTS)
    sp = spark.createDataFrame([(0, 1, day(3), 1.0)], SPINE_SCHEMA + ", amount_sum_7d double")
    with pytest.raises(ValueError):
        R.aggregate_features(f, AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7))]), spine=sp)


def test_composite_keys_rolling(spark):
    rnd = random.Random(23)
    rows = [(rnd.randint(1, 2), rnd.choice("xy"), rnd.randint(0, 30), float(rnd.randint(1, 9))) for _ in range(80)]
    f = spark.createDataFrame([(a, b, day(d), v) for a, b, d, v in rows], "a bigint, b string, t date, v double")
    pts = [(i, rnd.randint(1, 2), rnd.choice("xy"), rnd.randint(0, 35)) for i in range(40)]
    sp = spark.createDataFrame([(i, a, b, day(d)) for i, a, b, d in pts], "id bigint, a bigint, b string, t date")
    spec = AggregateSpec(["a", "b"], "t", [Agg("v", "sum", Lookback(5)), Agg("v", "count", Lookback(10, offset=2))])
    got = {r["id"]: r for r in R.aggregate_features(f, spec, spine=sp, bucket_width=4).collect()}
    for i, a, b, p in pts:
        s5 = [v for aa, bb, d, v in rows if (aa, bb) == (a, b) and p - 4 <= d <= p]
        c10 = [v for aa, bb, d, v in rows if (aa, bb) == (a, b) and p - 11 <= d <= p - 2]
        assert got[i]["v_sum_5d"] == (sum(s5) if s5 else None)
        assert got[i]["v_count_10d_offset_2d"] == len(c10)
    grid = R.aggregate_features(f, spec, mode="grid", bucket_width=4)
    assert grid.select("a", "b").distinct().count() == len({(a, b) for a, b, _, _ in rows})


def test_fact_pruning_keeps_answers(spark):
    rnd = random.Random(31)
    rows = [(rnd.randint(1, 3), rnd.randint(-40, 80), f"{rnd.randint(1, 999) / 10:.2f}") for _ in range(150)]
    sp = spine(spark, [(i, rnd.randint(1, 3), rnd.randint(20, 30)) for i in range(30)])
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(5, offset=9)),
                                    Agg("amount", "count", Lookback(3, closed="left"))])
    on = sorted(tuple(r) for r in R.aggregate_features(facts(spark, rows), spec, spine=sp,
                                                       prune_facts=True).collect())
    off = sorted(tuple(r) for r in R.aggregate_features(facts(spark, rows), spec, spine=sp).collect())
    assert on == off
    plan = R.aggregate_features(facts(spark, rows), spec, spine=sp,
                                prune_facts=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan.lower() or "subquery" in plan.lower()


def test_function_registry_by_name_alias_object_and_custom(spark):
    from pyspark.sql import functions as F

    from pitfeat.functions import aggregates as A

    assert A.get("avg") is A.get("mean") is A.get("AVG")

    class ApproxCountDistinct:  # an object carrying a name, as the reference imports one
        name = "approx_count_distinct"

    assert A.get(ApproxCountDistinct()) is A.get("approx_count_distinct")
    with pytest.raises(KeyError):
        A.get("median_of_medians")
    # a user-registered mergeable function: sum of squares
    A.register(A.AggFunction("sum_sq", {"sq": lambda c: F.sum(c * c)},
                             lambda col, w: F.sum(A.pname("sq", col)).over(w)))
    f = facts(spark, [(1, 0, "2.00"), (1, 1, "3.00")])
    spec = AggregateSpec("k", "t", [Agg("amount", "sum_sq", Lookback(2))])
    got = {r["t"]: r["amount_sum_sq_2d"] for r in R.aggregate_features(f, spec, mode="facts").collect()}
    assert got == {day(0): 4.0, day(1): 13.0}


def test_materialize_writes_then_reads_back(spark):
    from pitfeat.session import materialize
    df = spark.range(10).selectExpr("id", "rand() AS r")  # non-deterministic until written
    m = materialize(df, name="mat")
    a = sorted(tuple(x) for x in m.collect())
    assert a == sorted(tuple(x) for x in m.collect())
    assert "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()


def test_decimal_sources_run_as_unscaled_longs(spark):
    """Money in decimal(18,2) is aggregated as long cents: same doubles, long arithmetic in frames."""
    rnd = random.Random(41)
    rows = [(1, rnd.randint(0, 20), f"{rnd.randint(-99999, 999999) / 100:.2f}") for _ in range(60)]
    f = facts(spark, rows)
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(5)),
                                    Agg("amount", "max", Lookback(3)), Agg("amount", "approx_count_distinct", Lookback(9))])
    out = R.aggregate_features(f, spec, mode="facts")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38" not in plan
    for r in out.collect():
        p = (r["t"] - D0).days
        s7 = sum((Decimal(a) for _, d, a in rows if p - 6 <= d <= p), Decimal(0))
        assert r["amount_sum_7d"] == float(s7)  # the exact sum, rounded once
        assert r["amount_avg_5d"] == brute(rows, 1, p, "avg", 5)


def test_from_partials_spine_mode_equals_facts(spark):
    rnd = random.Random(13)
    rows = [(rnd.randint(1, 3), rnd.randint(0, 40), f"{rnd.randint(1, 99999) / 100:.2f}") for _ in range(120)]
    f = facts(spark, rows)
    spec = AggregateSpec("k", "t", [Agg("amount", "sum", Lookback(7)), Agg("amount", "avg", Lookback(5, offset=2)),
                                    Agg("amount", "count", Lookback(3, closed="left")),
                                    Agg("amount", "max", Lookback(10)), Agg("amount", "active_days", Lookback(6))])
    scales = R._decimal_scales(f, spec)
    # partials split in two tables per (key, day), as two batches of a stream could leave them
    half = [r for i, r in enumerate(rows) if i % 2], [r for i, r in enumerate(rows) if not i % 2]
    parts = [R.daily_partials(R._unscaled(facts(spark, h), scales), spec).drop("__ft", "__pt") for h in half]
    partials = parts[0].unionByName(parts[1])
    sp = spine(spark, [(i, rnd.randint(1, 4), rnd.randint(-2, 45)) for i in range(40)])
    got = sorted(tuple(r) for r in R.from_partials(partials, spec, scales, spine=sp).collect())
    want = sorted(tuple(r) for r in R.aggregate_features(f, spec, spine=sp).collect())
    assert got == want


def test_plan_report(spark):
    from pitfeat.plans.inspect import plan_report
    from pitfeat.sources.tables import Tables
    from paths import SF_SMALL
    t = Tables(spark, SF_SMALL)
    rep = plan_report(R.aggregate_features(t.txn_orders(), R.rolling_7_14_spec("account_id", "txn_date", "amount"),
                                           mode="facts"))
    assert rep["shuffles"] == 2 and rep["windows"] == 1 and rep["python_nodes"] == 0
    assert rep["scans"] and "o_totalprice" in rep["scans"][0]["read_schema"]
    assert "o_orderpriority" not in rep["scans"][0]["read_schema"]  # pruned


def test_hourly_grid_equals_spine(spark):
    hour = dt.timedelta(hours=1)
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(8)
    rows = [(rnd.randint(1, 2), t0 + dt.timedelta(minutes=rnd.randint(0, 60 * 30)), float(rnd.randint(1, 9)))
            for _ in range(80)]
    f = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double")
    spec = AggregateSpec("k", "ts", [Agg("v", "sum", Lookback(3 * hour)), Agg("v", "count", Lookback(2 * hour, offset=hour))],
                         start=t0, end=t0 + dt.timedelta(hours=30), granularity=hour)
    grid = {(r["k"], r["ts"]): r for r in R.aggregate_features(f, spec, mode="grid", bucket_width=5).collect()}
    assert len(grid) == 2 * 31
    pts = spark.createDataFrame([(i, k, t0 + dt.timedelta(hours=h, minutes=17)) for i, (k, h) in
                                 enumerate((k, h) for k in (1, 2) for h in range(0, 31, 2))],
                                "id bigint, k bigint, ts timestamp_ntz")
    for r in R.aggregate_features(f, spec, spine=pts).collect():
        g = grid[(r["k"], r["ts"].replace(minute=0))]
        assert (g["v_sum_3h"], g["v_count_2h_offset_1h"]) == (r["v_sum_3h"], r["v_count_2h_offset_1h"])


def test_few_points_of_a_grid_are_not_merged_into_few_tasks(spark):
    """The tasks that make a grid's many rows are as many as the session's shuffle partitions, however small its points are."""
    facts = spark.createDataFrame([(k, dt.date(2020, 1, 1 + k % 20), 1.0) for k in range(200)], "k bigint, d date, amount double")
    spec = AggregateSpec("k", "d", [Agg("amount", "sum", Lookback(7))], start=dt.date(2020, 1, 1), end=dt.date(2021, 12, 31))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grid = R.aggregate_features(facts, spec, mode="grid")
    tasks = grid.select(F.spark_partition_id().alias("t")).groupBy("t").count().collect()
    assert n > 1 and len(tasks) == n and sum(r["count"] for r in tasks) == 200 * 731
