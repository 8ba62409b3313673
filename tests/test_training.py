"""Training sets, feature specs with override, SCD-2, validation, ML smoke."""

import datetime as dt

import pytest

from pitfeat.operators import quality as Q
from pitfeat.operators import scd as S
from pitfeat.plans import ml as M
from pitfeat.plans import training as T
from pitfeat.session import scratch_path
from pitfeat.specs import FeatureFunction, FeatureLookup, FeatureSpec, TableSpec

D0 = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + dt.timedelta(days=n)


@pytest.fixture()
def world(spark):
    spine = spark.createDataFrame(
        [(1, 10, 100, day(5), True, 9.5), (2, 10, 101, day(1), False, 1.0), (3, 11, 999, day(7), False, 2.0),
         (3, 11, 999, day(7), False, 2.0)],
        "transaction_id bigint, acct bigint, merchant_id bigint, obs date, label boolean, amount double")
    merchants = spark.createDataFrame([(100, 3), (101, 4)], "merchant_id bigint, merchant_zone bigint")
    accounts = spark.createDataFrame([(10, day(0), day(3), 1), (10, day(3), None, 2), (11, day(0), None, 5)],
                                     "account_id bigint, valid_from date, valid_to date, zone bigint")
    tables = {"merchants": T.FeatureTable(merchants, TableSpec("merchant_id")),
              "accounts": T.FeatureTable(accounts, TableSpec("account_id", time_key="valid_from"), "valid_to")}
    feats = [FeatureLookup("merchants", ["merchant_zone"], "merchant_id"),
             FeatureLookup("accounts", ["zone"], "acct", time_key="obs"),
             FeatureFunction(lambda a, b: (a * 10 + b).cast("double"), {"a": "zone", "b": "merchant_zone"}, "dist")]
    return spine, tables, feats


def test_training_set_rows_columns_and_label(world):
    spine, tables, feats = world
    with pytest.warns(UserWarning):
        ts = T.training_set(spine, feats, tables, label="label",
                            exclude=["transaction_id", "customer_id", "merchant_zone", "zone", "obs"])
    assert ts.columns == ["acct", "merchant_id", "amount", "dist", "label"]
    rows = sorted(ts.collect(), key=lambda r: (r["acct"], r["amount"]))
    assert len(rows) == 4
    assert [r["dist"] for r in rows] == [14.0, 23.0, None, None]
    assert dict(ts.dtypes)["label"] == "double"


def test_nulls_drop_and_defaults(world):
    spine, tables, feats = world
    dropped = T.training_set(spine, feats, tables, label="label", nulls="drop")
    assert dropped.count() == 2
    filled = T.training_set(spine, feats, tables, label="label", defaults={"dist": -1.0, "merchant_zone": 0})
    assert sorted(r["dist"] for r in filled.collect()) == [-1.0, -1.0, 14.0, 23.0]


def test_override_fills_only_missing_and_skips_complete(spark, world):
    spine, tables, feats = world
    req = spine.selectExpr("acct", "merchant_id", "obs", "CASE WHEN merchant_id = 100 THEN 7 END AS merchant_zone")
    spec = FeatureSpec("s", feats)
    out = T.apply_spec(spec, req, tables)
    got = sorted((r["merchant_id"], r["merchant_zone"], r["dist"]) for r in out.collect())
    assert got == [(100, 7, 27.0), (101, 4, 14.0), (999, None, None), (999, None, None)]
    # a non-nullable supplied column skips its lookup altogether
    from pyspark.sql import functions as F
    full = req.withColumn("merchant_zone", F.coalesce("merchant_zone", F.lit(0)))
    plan = T.apply_spec(FeatureSpec("s", feats[:1]), full, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_build_scd2_chains_across_buckets(spark):
    ch = spark.createDataFrame([(1, day(d), d, i) for i, d in enumerate([0, 3, 3, 10, 31, 90])]
                               + [(2, day(4), 1, 99)], "k bigint, at date, zip int, cid int")
    for bucket in (dt.timedelta(days=2), dt.timedelta(days=512)):
        out = S.build_scd2(ch, "k", "at", ["cid", "zip"], order_by=["cid"], bucket=bucket)
        rows = sorted((r["k"], r["cid"], r["valid_from"], r["valid_to"], r["is_current"]) for r in out.collect())
        assert rows == [(1, 0, day(0), day(3), 0), (1, 1, day(3), day(3), 0), (1, 2, day(3), day(10), 0),
                        (1, 3, day(10), day(31), 0), (1, 4, day(31), day(90), 0), (1, 5, day(90), None, 1),
                        (2, 99, day(4), None, 1)]


def test_latest_snapshot_deterministic_with_null_feature(spark):
    df = spark.createDataFrame([(1, day(1), 5.0), (1, day(3), None), (2, day(2), 1.0), (2, day(2), 2.0)],
                               "k bigint, t date, v double")
    got = sorted(S.latest_snapshot(df, "k", "t").collect())
    assert [tuple(r) for r in got] == [(1, day(3), None), (2, day(2), 2.0)]


def test_validators(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k bigint, v string")
    assert [tuple(r) for r in Q.validate_unique(df, "k").collect()] == [(1, 2)]
    assert Q.validate_not_null(df, ["k", "v"]).count() == 2
    nc = {r["column_name"]: (r["null_rows"], r["total_rows"]) for r in Q.null_counts(df, ["k", "v"]).collect()}
    assert nc == {"k": (1, 4), "v": (1, 4)}
    dim = spark.createDataFrame([(1,)], "k bigint")
    assert sorted(r["k"] for r in Q.orphans(df, "k", dim, "k").collect()) == [2]
    checks = Q.validate_spec(df, TableSpec("k"))
    assert checks["unique"].count() == 1


def test_split_is_stable_and_disjoint(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "acct")
    tr, te = M.split(df, "acct", 0.8)
    a, b = {r[0] for r in tr.collect()}, {r[0] for r in te.collect()}
    assert not a & b and len(a) + len(b) == 2000
    assert 1450 < len(a) < 1750
    tr2, _ = M.split(df.repartition(7), "acct", 0.8)
    assert {r[0] for r in tr2.collect()} == a


def test_fit_tree_and_score(spark):
    rows = [(float(i % 7), float(i % 3), float(i % 7 > 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, y double, label double")
    model, feats = M.fit_tree(df, "label")
    assert feats == ["x", "y"]
    scored = M.score_supplied(df, model, feats)
    acc = scored.where("prediction = label").count() / 300
    assert acc > 0.95


def test_catalog_helpers_and_sinks(spark):
    from pitfeat.sources import catalog as C
    df = C.local_frame(spark, [(2, "b"), (1, "a"), (3, None)], "k bigint, v string")
    assert [tuple(r) for r in C.input_example(df, 2, ["k"]).collect()] == [(1, "a"), (2, "b")]
    path = scratch_path(spark, "sink")
    C.save_table(df, "ignored", path=path)
    C.save_table(df.withColumn("w", df.k * 2), "ignored", path=path)  # overwrite replaces the schema
    assert spark.read.parquet(path).columns == ["k", "v", "w"]
    C.create_view(df, "tiny_view")
    assert "tiny_view" in C.list_tables(spark)


def test_grid_guard(spark):
    from pitfeat.operators import rolling as R
    from pitfeat.specs import Agg, AggregateSpec, Lookback
    f = spark.createDataFrame([(1, day(0), 1.0), (2, day(9), 2.0)], "k bigint, t date, a double")
    spec = AggregateSpec("k", "t", [Agg("a", "sum", Lookback(3))])
    assert R.grid_size(f, spec) == 20
    with pytest.raises(ValueError):
        R.aggregate_features(f, spec, mode="grid", max_cells=19)
    assert R.aggregate_features(f, spec, mode="grid", max_cells=20).count() == 20


def test_weighted_tree(spark):
    rows = [(float(i % 5), float(i % 50 == 0), 1.0 if i % 50 else 30.0) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, label double, w double")
    model, feats = M.fit_tree(df, "label", features=["x"], weight_col="w")
    assert feats == ["x"]
    assert M.score_supplied(df, model, feats).count() == 500


def test_lookup_without_time_on_time_series_table_reads_latest(spark):
    spine = spark.createDataFrame([(1,), (2,)], "acct bigint")
    ts = spark.createDataFrame([(1, day(1), 5.0), (1, day(4), 7.0), (2, day(2), 1.0)],
                               "account_id bigint, date date, total double")
    tables = {"rollups": T.FeatureTable(ts, TableSpec("account_id", time_key="date"))}
    out = T.training_set(spine, [FeatureLookup("rollups", ["total"], "acct")], tables)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 7.0), (2, 1.0)]


def test_client_call_shapes(spark, world):
    from pitfeat.plans.client import FeatureClient
    from pitfeat.specs import Agg, AggregateSpec, Lookback
    spine, tables, feats = world
    fc = FeatureClient(spark)
    for name, t in tables.items():
        t.df.createOrReplaceTempView(f"client_{name}")
        fc.register_table(name, f"client_{name}", t.spec, t.valid_to)  # by catalog name
    ts = fc.create_training_set(df=spine, feature_lookups=feats, label="label",
                                exclude_columns=["transaction_id", "obs"])
    df = ts.load_df()
    assert df.count() == 4 and df.columns[-1] == "label"
    fc.create_feature_spec("s", feats)
    assert fc.apply_spec("s", spine.drop("label")).count() == 4
    txns = spark.createDataFrame([(10, day(0), 5.0), (10, day(2), 7.0)], "acct bigint, t date, amount double")
    fc.register_table("txns", txns, TableSpec("acct", time_key="t"))
    grid = fc.aggregate_features(features=AggregateSpec("acct", "t", [Agg("amount", "sum", Lookback(2))],
                                                        source="txns"))
    assert [r["amount_sum_2d"] for r in grid.orderBy("t").collect()] == [5.0, 5.0, 7.0]
    pm = fc.fit_model(ts)
    scored = fc.score_batch(pm, spine.select("acct", "merchant_id", "obs", "amount"))
    assert scored.count() == 4 and "prediction" in scored.columns


def test_aggregations_in_feature_list_share_one_reattach(spark, world):
    from pitfeat.operators.rolling import aggregate_features
    from pitfeat.specs import Agg, AggregateSpec, FeatureAggregation, Lookback
    spine, tables, feats = world
    txns = spark.createDataFrame([(10, day(0), 5.0), (10, day(4), 7.0), (11, day(6), 1.0), (10, day(5), 2.0)],
                                 "account_id bigint, t date, amount double")
    tabs = {**tables, "txns": T.FeatureTable(txns, TableSpec("account_id", time_key="t"))}
    spec = AggregateSpec("account_id", "t", [Agg("amount", "sum", Lookback(3)), Agg("amount", "count", Lookback(7))])
    fa = FeatureAggregation("txns", spec, "acct", "obs")
    shared = T.training_set(spine, [fa, *feats], tabs, label="label")
    manual = T.training_set(aggregate_features(txns, spec, spine=spine, on={"acct": "account_id", "obs": "t"}),
                            feats, tables, label="label")
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, manual.select(*shared.columns).collect()))
    plan = shared._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") >= 1
    # timestamp observation times take the separate path and agree too
    ts_spine = spine.withColumn("obs", spine["obs"].cast("timestamp_ntz"))
    sep = T.training_set(ts_spine, [fa, feats[1]], tabs, label="label")
    assert sorted((r["amount_sum_3d"], r["zone"]) for r in sep.collect()) == \
        sorted((r["amount_sum_3d"], r["zone"]) for r in shared.collect())
    # JSON round trip of a spec holding an aggregation
    js = FeatureSpec("s", [fa, *feats[:2]])
    assert FeatureSpec.from_json(js.to_json()).features[0].spec.names == spec.names


def test_aggregation_override_fills_missing(spark, world):
    from pitfeat.specs import Agg, AggregateSpec, FeatureAggregation, Lookback
    spine, tables, feats = world
    txns = spark.createDataFrame([(10, day(0), 5.0), (10, day(4), 7.0)], "account_id bigint, t date, amount double")
    tabs = {**tables, "txns": T.FeatureTable(txns, TableSpec("account_id", time_key="t"))}
    spec = AggregateSpec("account_id", "t", [Agg("amount", "sum", Lookback(7))])
    req = spine.selectExpr("acct", "obs", "CASE WHEN merchant_id = 100 THEN 99.0 END AS amount_sum_7d")
    out = T.apply_spec(FeatureSpec("s", [FeatureAggregation("txns", spec, "acct", "obs")]), req, tabs)
    got = sorted((str(r["obs"]), r["amount_sum_7d"]) for r in out.collect())
    assert got == [("2024-01-02", 5.0), ("2024-01-06", 99.0), ("2024-01-08", None), ("2024-01-08", None)]


def test_validate_versions(spark):
    df = spark.createDataFrame(
        [(1, day(0), day(5)), (1, day(5), day(9)), (1, day(8), None),      # day 8 overlaps (ends 9 > 8)
         (2, day(0), None), (2, day(3), None),                               # open and not last
         (3, day(0), day(2)), (3, day(4), None)],                            # a gap is fine
        "k bigint, vf date, vt date")
    bad = sorted((r["k"], r["vf"]) for r in Q.validate_versions(df, "k", "vf", "vt").collect())
    assert bad == [(1, day(5)), (2, day(0))]


def test_bucketed_dimension_needs_no_shuffle_on_its_side(spark):
    from pitfeat.operators.lookup import lookup_exact
    from pitfeat.sources import catalog as C
    dim = spark.range(0, 5000).selectExpr("id AS merchant_id", "id % 25 AS zone")
    C.save_table(dim, "merchants_bucketed", path=scratch_path(spark, "mb"), bucket_by=(8, ["merchant_id"]))
    facts = spark.range(0, 200000).selectExpr("id AS txn", "id % 5000 AS merchant_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_exact(facts, spark.table("merchants_bucketed"), "merchant_id", "merchant_id", ["zone"],
                           prefilter=False)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 200000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 1  # only the fact side moves


def test_materialized_spine_gives_the_same_set(world):
    spine, tables, feats = world
    a = T.training_set(spine, feats, tables, label="label")
    b = T.training_set(spine, feats, tables, label="label", materialize_spine=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert "Scan parquet" in b._jdf.queryExecution().executedPlan().toString()


def test_select_features_multi_step_elimination(spark):
    import random as _r
    rnd = _r.Random(3)
    rows = []
    for _ in range(400):
        a, b, c, d = (rnd.random() for _ in range(4))
        rows.append((a, b, c, d, float(a + 0.5 * b > 0.8)))
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, label double")
    tr, te = df.limit(300), df.limit(400).subtract(df.limit(300))
    out = M.select_features(tr, te, "label", ["a", "b", "c", "d"], k=1, max_iter=3, steps=3, seed=1)
    got = {r["feature"]: r for r in out.collect()}
    assert sum(r["selected"] for r in got.values()) == 1
    assert got["a"]["selected"]  # the strongest signal survives
    assert sorted(r["eliminated_at"] for r in got.values() if not r["selected"]) == [0, 1, 2]


def test_lookups_keyed_on_earlier_outputs(spark):
    spine = spark.createDataFrame([(1, day(3)), (2, day(9)), (3, day(1))], "id bigint, obs date")
    owner = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, acct bigint")
    zones = spark.createDataFrame([(10, day(0), 1), (20, day(0), 2), (20, day(8), 3)], "acct bigint, vf date, zone bigint")
    tables = {"owner": T.FeatureTable(owner, TableSpec("id")), "zones": T.FeatureTable(zones, TableSpec("acct", time_key="vf"))}
    feats = [FeatureLookup("owner", ["acct"], "id"), FeatureLookup("zones", ["zone"], "acct", time_key="obs")]
    out, names = T.compile_features(spine, feats, tables)
    assert names == ["acct", "zone"]
    assert sorted((r["id"], r["zone"]) for r in out.collect()) == [(1, 1), (2, 3), (3, None)]


def test_packaged_model_saves_and_loads(spark):
    from pitfeat.plans.client import FeatureClient, PackagedModel
    fc = FeatureClient(spark)
    zones = spark.createDataFrame([(k, k * 10) for k in range(4)], "acct bigint, zone bigint")
    fc.register_table("zones", zones, TableSpec("acct"))
    hist = spark.createDataFrame([(i % 4, float(i % 4 > 1)) for i in range(80)], "acct bigint, label double")
    model = fc.fit_model(fc.create_training_set(df=hist, feature_lookups=[FeatureLookup("zones", ["zone"], "acct")], label="label"))
    path = scratch_path(spark, "package")
    model.save(spark, path)
    back = PackagedModel.load(spark, path)
    assert (back.inputs, back.label, back.spec) == (model.inputs, model.label, model.spec)
    rows = [sorted((r["acct"], r["prediction"]) for r in fc.score_batch(m, zones.select("acct")).collect()) for m in (model, back)]
    assert rows[0] == rows[1] == [(0, 0.0), (1, 0.0), (2, 1.0), (3, 1.0)]
