import datetime as dt

import pytest

from pitfeat.specs import (Agg, AggregateSpec, FeatureFunction, FeatureLookup, FeatureSpec, Lookback,
                           TableSpec, expand_search_space)


def test_lookback_frames():
    assert Lookback(7).frame() == (-6, 0)
    assert Lookback(14).frame() == (-13, 0)
    assert Lookback(5, offset=dt.timedelta(days=-2)).frame() == (-6, -2)
    assert Lookback(5, offset=5).frame() == (-9, -5)
    assert Lookback(7, closed="left").frame() == (-7, -1)
    hour = dt.timedelta(hours=1)
    assert Lookback(2 * hour, offset=hour).frame(hour) == (-2, -1)


def test_names_follow_reference_rule():
    assert Agg("amount", "avg", Lookback(15)).output_name() == "amount_avg_15d"
    assert Agg("amount", "sum", Lookback(5, offset=-10)).output_name() == "amount_sum_5d_offset_10d"
    assert Agg("amount", "sum", Lookback(7, closed="left")).output_name() == "amount_sum_7d_excl"


def test_search_space_expansion_order():
    space = [
        {"column": "amount", "window": [15, 30], "function": ["avg", "sum"]},
        {"column": "amount", "window": [5, 10], "offset": [5, 10], "function": ["avg", "sum"]},
    ]
    names = [a.output_name() for a in expand_search_space(space)]
    # the naming rule: column_function_window, then the offset; functions vary fastest, then offsets, then windows
    rule = [f"amount_{f}_{w}d" for w in (15, 30) for f in ("avg", "sum")]
    rule += [f"amount_{f}_{w}d_offset_{o}d" for w in (5, 10) for o in (5, 10) for f in ("avg", "sum")]
    assert names == rule and len(names) == 12


def test_aggregate_spec_validation():
    with pytest.raises(ValueError):
        AggregateSpec("k", "t", [Agg("a", "sum", Lookback(7)), Agg("a", "sum", Lookback(7))])
    spec = AggregateSpec("k", "t", expand_search_space(
        [{"column": "a", "window": [5, 10], "offset": [5, 10], "function": ["sum"]}]))
    assert spec.max_span == 19


def test_feature_spec_json_round_trip():
    spec = FeatureSpec("s", [
        FeatureLookup("rollups", ["x", "y"], "acct", time_key="obs", rename={"x": "x2"}),
        FeatureFunction("distance", {"a": "x2", "b": "y"}, "d"),
    ])
    back = FeatureSpec.from_json(spec.to_json())
    assert back == spec
    assert back.output_names() == ["x2", "y", "d"]


def test_table_spec():
    t = TableSpec("customer_id", time_key="valid_from")
    assert t.primary_key == ("customer_id", "valid_from")
    with pytest.raises(ValueError):
        t.validate(["customer_id"])


def test_cluster_profile_sizing():
    from pitfeat.session import cluster_profile
    p = cluster_profile(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(p["spark.sql.shuffle.partitions"]) == 409601
    small = cluster_profile(2**30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 120


def test_search_space_entries_are_checked():
    import pytest
    one = expand_search_space([{"column": "a", "window": 7, "function": "sum", "offset": [0, -7], "closed": ["right", "left"], "default": 0}])
    assert [(x.window.closed, x.default) for x in one] == [("right", 0), ("left", 0)] * 2
    for bad in ({"column": "a", "window": [1]}, {"column": "a", "window": [], "function": "sum"}, {"window": [1], "function": "sum"},
                {"column": "a", "window": [1], "function": "sum", "windows": 1}):
        with pytest.raises(ValueError, match="search-space entry"):
            expand_search_space([bad])


def test_checkpoint_folder_of_our_own_only_for_a_local_master():
    import pytest
    from pitfeat.session import own_folder
    assert own_folder("local[2]") and own_folder("local")
    for master in ("yarn", "k8s://x", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            own_folder(master)


def test_latest_snapshot_leaves_null_keys_out(spark):
    from pitfeat.operators.scd import latest_snapshot
    df = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (None, 9, "c")], "k int, t int, v string")
    assert [tuple(r) for r in latest_snapshot(df, "k", "t").collect()] == [(1, 6, "b")]
