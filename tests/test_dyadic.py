"""Long windows of sketches by dyadic blocks."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitfeat import Agg, AggregateSpec, Lookback
from pitfeat.operators import rolling as R
from pitfeat.operators.dyadic import blocks


@pytest.mark.parametrize("levels", [0, 3, 8])
def test_blocks_tile_an_interval(spark, levels):
    r = np.random.default_rng(levels)
    rows = [(int(a), int(a + n)) for a, n in zip(r.integers(-300, 300, 200), r.integers(0, 2 ** (levels + 1) - 1, 200))] + [(5, 4)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", blocks(F.col("a"), F.col("b"), levels).alias("x")).collect()
    for row in got:
        cells = [g for level, block in row["x"] for g in range(block << level, (block + 1) << level)]
        assert sorted(cells) == list(range(row["a"], row["b"] + 1)) and len(row["x"]) <= 2 * (levels + 1)


def test_counts_equal_the_sliding_union(spark, monkeypatch):
    r = np.random.default_rng(7)
    rows = [(int(k), dt.date(2020, 1, 1) + dt.timedelta(days=int(d)), int(v)) for k, d, v in zip(r.integers(0, 4, 2500), r.integers(0, 900, 2500), r.integers(0, 300, 2500))]
    facts = spark.createDataFrame(rows, "k long, d date, v long")
    aggs = [Agg("v", "approx_count_distinct", Lookback(n, offset=o, closed=c), name=f"n{i}") for i, (n, o, c) in enumerate(
        ((365, 0, "right"), (100, -20, "right"), (64, 0, "left"), (10, 0, "right")))] + [Agg("v", "count", Lookback(100))]
    spec = AggregateSpec("k", "d", aggs)
    spine = spark.createDataFrame([(k, dt.date(2019, 12, 1) + dt.timedelta(days=i)) for k in (0, 3, 9) for i in range(0, 950, 11)], "k long, d date")
    results = []
    for least in (64, 10 ** 6):
        monkeypatch.setattr(R, "LONG_SKETCH", least)
        for mode in ({"mode": "facts"}, {"spine": spine}):
            results.append(sorted(map(tuple, R.aggregate_features(facts, spec, **mode).select("k", "d", *spec.names).collect())))
    assert results[0] == results[2] and results[1] == results[3]
    assert len(results[1]) == spine.count() and any(row[3] == 0 for row in results[1])
