"""What a query may cost as its input grows: plans, bytes and rows dealt out, beside the results."""

from collections import Counter

from pyspark.sql import functions as F

from paths import SF_SMALL
from pitfeat import workloads as W
from pitfeat.workloads import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counted(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_row_function_runs_on_all_cores_without_a_table_per_row(spark):
    out = QUERIES["expand_versions"](spark, SF_SMALL)
    assert "ArrowEvalPythonUDTF" not in plan(out) and "BatchEvalPythonUDTF" in plan(out)
    assert spark.read.parquet(f"{SF_SMALL}/customer.parquet").rdd.getNumPartitions() < out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def joins(df) -> list[str]:
    return [line.split("Join", 1)[1] for line in plan(df).splitlines() if "Join " in line]


def test_long_sketch_windows_join_no_sketches(spark):
    """Only lines and orders are joined: the windows' sketches stay in the tasks that union them."""
    assert len(joins(QUERIES["window_distinct_365"](spark, SF_SMALL))) == 1


def test_exact_distinct_counts_join_no_ranges(spark):
    """Points are not paired with the days of their windows: every join is on equal keys alone."""
    conditions = joins(QUERIES["window_distinct_checked"](spark, SF_SMALL))
    assert conditions and not any(sign in c for c in conditions for sign in (">", "<"))


def exchanges(df) -> int:
    return sum("Exchange hashpartitioning" in line for line in plan(df).splitlines())


def test_distinct_counts_are_dealt_out_once(spark):
    """Beside what joins lines and orders: granules and their groups are shuffled, with the exact counts also lines by bucket
    and both sides of the last join. No blocks, steps or running sums are."""
    small = [exchanges(QUERIES[q](spark, SF_SMALL)) for q in ("window_distinct_365", "window_distinct_checked")]
    assert small[0] <= 2 and small[1] <= 5
    # the groups' tasks are not merged by bytes: their rows grow there
    assert plan(QUERIES["window_distinct_checked"](spark, SF_SMALL)).count("REPARTITION_BY_NUM") == 2


def test_exact_distinct_counts_at_bucket_edges(spark, monkeypatch):
    """Buckets shorter than the windows give the counts that one bucket for all days gives."""
    found = []
    for width in (100_000, 200):
        monkeypatch.setattr(W, "DISTINCT_BUCKET", width)
        found.append(sorted(map(tuple, QUERIES["window_distinct_checked"](spark, SF_SMALL).collect())))
    assert found[0] and found[0] == found[1] and any(row[2] != row[3] for row in found[0])


def generated(spark, df) -> int:
    """Rows that the plan's explodes made, collected without AQE."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        nodes, total = [df._jdf.queryExecution().executedPlan()], 0
        while nodes:
            node = nodes.pop()
            if node.nodeName() == "Generate":
                total += node.metrics().apply("numOutputRows").value()
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
        return total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_interval_join_sends_a_row_to_few_levels(spark):
    """Versions of 1 s to 68 years: a spine row goes to 10 levels at most, and finds what the plain join finds."""
    from pitfeat.operators import lookup as L

    start = 1_600_000_000
    versions = spark.createDataFrame([(1, start + 7 * n, start + 7 * n + (1 << n), n) for n in range(32)] + [(1, start, None, 99)], "k long, a long, b long, v int")
    versions = versions.selectExpr("k", "timestamp_seconds(a) AS a", "timestamp_seconds(b) AS b", "v")
    spine = spark.createDataFrame([(1, start + s) for s in [*range(-50, 300, 3), 1 << 20, 1 << 30, 1 << 31]], "k long, t long").selectExpr("k", "timestamp_seconds(t) AS t")
    out = L.lookup_interval(spine, versions, "k", "k", "t", "a", "b", ["v"], strategy="join")
    want = spine.alias("s").join(versions.alias("r"), F.expr("s.k = r.k AND a <= t AND (b IS NULL OR t < b)"), "left").select("s.k", "t", "v")
    assert counted(out) == counted(want)
    assert generated(spark, out) <= 10 * spine.count() + 2 * versions.count()


def test_refreshed_grid_deals_out_runs_not_cells(spark):
    """Three keys' grids of 20,000 days: late facts touch few cells in two far runs, an early new key all of its own."""
    import datetime as dt

    from pitfeat import Agg, AggregateSpec, Lookback
    from pitfeat.operators import rolling as R

    day = lambda n: dt.date(1970, 1, 1) + dt.timedelta(days=n)
    frame = lambda r: spark.createDataFrame(r, "k long, d date, x long")
    early = frame([(1, day(5), 1), (1, day(19_999), 2), (2, day(40), 3)])
    late = frame([(1, day(700), 4), (1, day(690), 5), (1, day(12_000), 6), (3, day(9), 7), (2, day(41), None)])
    spec = AggregateSpec("k", "d", [Agg("x", "sum", Lookback(30)), Agg("x", "count", Lookback(5, offset=-2))], start=day(0), end=None)
    old = R.aggregate_features(early, spec, mode="grid")
    whole = early.union(late)
    written = old.localCheckpoint()
    got = R.refresh_grid(written, whole, late, spec)
    assert counted(got) == counted(R.aggregate_features(whole, spec, mode="grid"))
    # one explode makes the rows of the runs; none deals out cells before a shuffle
    before_shuffle = [line for line in plan(got).splitlines() if "Generate explode(sequence(a" in line]
    assert not before_shuffle and generated(spark, got) < 21_000
