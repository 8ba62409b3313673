"""Streams: replay in several batches equals one batch; re-runs are idempotent."""

import datetime as dt
import time

from pitfeat.operators import scd as S
from pitfeat.session import scratch_path
from pitfeat.streaming import jobs as ST

D0 = dt.date(2024, 1, 1)


def test_publish_latest_batches_equal_one_batch(spark):
    rows = [(k, D0 + dt.timedelta(days=d), float(k * 100 + d)) for k in range(20) for d in range(0, 30, 3)]
    src = scratch_path(spark, "pub-src")
    # many small files, written out of time order
    spark.createDataFrame(rows, "k bigint, t date, v double").repartition(9).write.parquet(src)
    schema = spark.read.parquet(src).schema
    want = sorted(tuple(r) for r in S.latest_snapshot(spark.read.parquet(src), "k", "t").collect())
    for per_batch in (1, 4, 100):
        out, ck = scratch_path(spark, "pub"), scratch_path(spark, "pub-ck")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(src)
        ST.publish_latest(stream, "k", "t", out, ck).awaitTermination()
        got = sorted(tuple(r) for r in ST.read_published(spark, out, "k", "t").select("k", "t", "v").collect())
        assert got == want, per_batch
        # restart from the checkpoint: nothing new, same answer
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(src)
        ST.publish_latest(stream, "k", "t", out, ck).awaitTermination()
        again = sorted(tuple(r) for r in ST.read_published(spark, out, "k", "t").select("k", "t", "v").collect())
        assert again == want
        whole = scratch_path(spark, "pub-whole")
        ST.compact_published(spark, out, whole, "k", "t")
        assert sorted(tuple(r) for r in ST.read_published(spark, whole, "k", "t").select("k", "t", "v").collect()) == want


def test_enrich_stream_with_full_spec(spark):
    from pitfeat.plans import training as T
    from pitfeat.specs import FeatureFunction, FeatureLookup, FeatureSpec, TableSpec
    req_rows = [(1, 100, dt.datetime(2024, 1, 5, 12)), (1, 101, dt.datetime(2024, 1, 1, 8)),
                (2, 999, dt.datetime(2024, 1, 9))]
    src = scratch_path(spark, "req-src")
    spark.createDataFrame(req_rows, "acct bigint, merchant_id bigint, ts timestamp_ntz").write.parquet(src)
    merchants = spark.createDataFrame([(100, 3), (101, 4)], "merchant_id bigint, merchant_zone bigint")
    accounts = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 1), (1, dt.datetime(2024, 1, 3), 2)],
                                     "account_id bigint, valid_from timestamp_ntz, zone bigint")
    tables = {"merchants": T.FeatureTable(merchants, TableSpec("merchant_id")),
              "accounts": T.FeatureTable(accounts, TableSpec("account_id", time_key="valid_from"))}
    spec = FeatureSpec("s", [FeatureLookup("merchants", ["merchant_zone"], "merchant_id"),
                             FeatureLookup("accounts", ["zone"], "acct", time_key="ts"),
                             FeatureFunction(lambda a, b: a * 10 + b, {"a": "zone", "b": "merchant_zone"}, "d")])
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    out, ck = scratch_path(spark, "req-out"), scratch_path(spark, "req-ck")
    ST.run_to_files(ST.enrich_with_spec(stream, spec, tables), out, ck)
    got = sorted((r["merchant_id"], r["zone"], r["d"]) for r in spark.read.parquet(out).collect())
    assert got == [(100, 2, 23), (101, 1, 14), (999, None, None)]


def test_stream_rolling_is_zone_independent(spark):
    rows = [(1, dt.datetime(2024, 3, 9, 22) + dt.timedelta(hours=5 * i), 1.0 + i) for i in range(30)]
    src = scratch_path(spark, "roll-src")
    spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double").write.parquet(src)
    schema = spark.read.parquet(src).schema
    results = []
    try:
        for tz in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            agg = ST.stream_rolling(spark.readStream.schema(schema).parquet(src), "k", "ts", "v",
                                    duration="2 days", slide="1 day", watermark="1 day")
            out = scratch_path(spark, "roll-out")
            ST.run_to_files(agg, out, scratch_path(spark, "roll-ck"))
            results.append(sorted(tuple(r) for r in spark.read.parquet(out).collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert results[0] == results[1] and results[0]
    assert all(r[1].hour == 0 and r[1].minute == 0 for r in results[0])


def test_late_rows_beyond_the_watermark_are_dropped_and_counted(spark):
    import time as _time
    src = scratch_path(spark, "late-src")
    # Spark judges lateness against the previous batch's watermark, so the late
    # row comes in the third micro-batch; file times order the batches
    batches = [[(1, dt.datetime(2024, 1, 10, 12), 5.0)],
               [(1, dt.datetime(2024, 1, 20, 12), 7.0)],
               [(1, dt.datetime(2024, 1, 2, 12), 100.0)]]  # 18 days behind the watermark
    for name, rows in zip("abc", batches):
        spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, v double").coalesce(1) \
            .write.parquet(f"{src}/{name}")
        _time.sleep(1.1)
    schema = spark.read.parquet(src + "/a").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true") \
        .parquet(src)
    out = scratch_path(spark, "late-out")
    q = ST.run_to_files(ST.stream_rolling(stream, "k", "ts", "v", duration="2 days", slide="1 day",
                                          watermark="1 day"), out, scratch_path(spark, "late-ck"))
    rows = spark.read.parquet(out).collect()
    assert all(r["v_sum"] != 100.0 for r in rows)
    # counted per window the late row falls in (2 windows of a 2-day window sliding by a day)
    assert ST.dropped_by_watermark(q) == 2


def test_stream_partials_feed_batch_windows(spark):
    import random
    from decimal import Decimal

    from pitfeat.operators import rolling as R
    from pitfeat.specs import Agg, AggregateSpec, Lookback
    rnd = random.Random(5)
    rows = sorted([(rnd.randint(1, 3), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20)),
                    Decimal(rnd.randint(1, 99999)) / 100) for _ in range(300)], key=lambda r: r[1])
    src = scratch_path(spark, "parts-src")
    for i in range(4):  # four files in time order -> four micro-batches
        spark.createDataFrame(rows[i * 75:(i + 1) * 75], "k bigint, ts timestamp_ntz, amount decimal(18,2)") \
            .coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    spec = AggregateSpec("k", "ts", [Agg("amount", "sum", Lookback(3)), Agg("amount", "count", Lookback(7)),
                                     Agg("amount", "max", Lookback(2, offset=1)),
                                     Agg("amount", "approx_count_distinct", Lookback(5))])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    parts, scales = ST.stream_partials(stream, spec, watermark="1 day")
    out = scratch_path(spark, "parts-out")
    ST.run_to_files(parts, out, scratch_path(spark, "parts-ck"))
    got = sorted(tuple(r) for r in R.from_partials(spark.read.parquet(out), spec, scales).collect())
    last_closed = max(r[1] for r in rows) - dt.timedelta(days=1)
    closed = [r for r in rows if dt.datetime.combine(r[1].date(), dt.time()) + dt.timedelta(days=1) <= last_closed]
    facts = spark.createDataFrame(closed, "k bigint, ts timestamp_ntz, amount decimal(18,2)")
    want = sorted(tuple(r) for r in R.aggregate_features(facts, spec, mode="facts").collect())
    assert got == want and len(got) > 10


def test_publish_latest_breaks_time_ties_by_order_by(spark):
    src = scratch_path(spark, "tie-src")
    d = dt.date(2024, 1, 5)
    for i, rows in enumerate([[(1, d, 1, 10.0), (2, d, 1, 5.0)], [(1, d, 3, 30.0), (1, dt.date(2024, 1, 4), 9, 99.0)],
                              [(1, d, 2, 20.0)]]):
        spark.createDataFrame(rows, "k bigint, t date, seq int, v double").coalesce(1) \
            .write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    out, ck = scratch_path(spark, "tie"), scratch_path(spark, "tie-ck")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    ST.publish_latest(stream, "k", "t", out, ck, order_by=["seq"]).awaitTermination()
    got = sorted((r["k"], r["seq"], r["v"]) for r in ST.read_published(spark, out, key="k", time="t",
                                                                        order_by=["seq"]).collect())
    # key 1: day 5 beats day 4 whatever its seq; among day-5 rows the highest seq wins
    assert got == [(1, 3, 30.0), (2, 1, 5.0)]


def test_stream_requests_scored_with_a_packaged_model(spark):
    from pitfeat.plans.client import FeatureClient
    from pitfeat.specs import FeatureLookup, TableSpec
    hist = spark.createDataFrame([(i % 4, dt.date(2024, 1, 1 + i % 20), float(i % 4 > 1)) for i in range(200)],
                                 "acct bigint, obs date, label double")
    accounts = spark.createDataFrame([(k, dt.date(2023, 1, 1), k * 10) for k in range(4)],
                                     "account_id bigint, valid_from date, zone bigint")
    fc = FeatureClient(spark)
    fc.register_table("accounts", accounts, TableSpec("account_id", time_key="valid_from"))
    lookups = [FeatureLookup("accounts", ["zone"], "acct", time_key="obs")]
    model = fc.fit_model(fc.create_training_set(df=hist, feature_lookups=lookups, label="label"))
    src = scratch_path(spark, "score-src")
    spark.createDataFrame([(k, dt.date(2024, 2, 1)) for k in range(4)], "acct bigint, obs date").write.parquet(src)
    stream = spark.readStream.schema("acct bigint, obs date").parquet(src)
    out = scratch_path(spark, "score-out")
    ST.run_to_files(ST.enrich_with_spec(stream, model.spec, fc.tables, model=model), out,
                    scratch_path(spark, "score-ck"))
    got = sorted((r["acct"], r["prediction"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, 0.0), (1, 0.0), (2, 1.0), (3, 1.0)]
    # FeatureSpec.apply is the method form of apply_spec
    batch = model.spec.apply(spark.read.parquet(src), fc.tables)
    assert sorted(r["zone"] for r in batch.collect()) == [0, 10, 20, 30]


def test_apply_spec_on_a_stream_switches_to_stream_static_joins(spark):
    from pitfeat.plans.training import FeatureTable, apply_spec
    from pitfeat.specs import FeatureLookup, FeatureSpec, TableSpec
    accounts = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5), (1, dt.date(2024, 1, 9), 6)],
                                     "account_id bigint, valid_from date, zone bigint")
    src = scratch_path(spark, "ap-src")
    spark.createDataFrame([(1, dt.date(2024, 1, 5)), (1, dt.date(2024, 1, 10))], "acct bigint, obs date") \
        .write.parquet(src)
    stream = spark.readStream.schema("acct bigint, obs date").parquet(src)
    spec = FeatureSpec("s", [FeatureLookup("accounts", ["zone"], "acct", time_key="obs")])
    out = scratch_path(spark, "ap-out")
    ST.run_to_files(apply_spec(spec, stream, {"accounts": FeatureTable(accounts, TableSpec(
        "account_id", time_key="valid_from"))}), out, scratch_path(spark, "ap-ck"))
    assert sorted((str(r["obs"]), r["zone"]) for r in spark.read.parquet(out).collect()) == \
        [("2024-01-05", 5), ("2024-01-10", 6)]


def test_publish_without_time_keeps_the_row_published_last(spark):
    src = scratch_path(spark, "t1-src")
    for rows in ([(1, "a"), (2, "b")], [(1, "A")]):
        spark.createDataFrame(rows, "k bigint, name string").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # file times order the batches
    stream = spark.readStream.schema("k bigint, name string").option("maxFilesPerTrigger", 1).parquet(src)
    out, whole = scratch_path(spark, "t1"), scratch_path(spark, "t1-whole")
    ST.publish_latest(stream, "k", None, out, scratch_path(spark, "t1-ck")).awaitTermination()
    ST.compact_published(spark, out, whole, "k")
    for path in (out, whole):
        assert sorted(tuple(r) for r in ST.read_published(spark, path, "k").collect()) == [(1, "A"), (2, "b")]


def test_open_windows_are_emitted_in_update_mode(spark):
    src = scratch_path(spark, "open-src")
    for day, v in ((1, 1.0), (1, 2.0), (2, 4.0)):
        spark.createDataFrame([(1, dt.datetime(2024, 1, day, 12), v)], "k bigint, ts timestamp_ntz, v double") \
            .coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("k bigint, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).parquet(src)
    out = scratch_path(spark, "open")
    ST.run_updates(ST.stream_rolling(stream, "k", "ts", "v", duration="2 days", watermark="5 days"), out, scratch_path(spark, "open-ck"))
    got = {str(r["window_start"].date()): r["v_sum"] for r in ST.read_published(spark, out, ["k", "window_start"]).collect()}
    assert got == {"2023-12-31": 3.0, "2024-01-01": 7.0, "2024-01-02": 4.0}
