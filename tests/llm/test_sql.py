"""Queries with a SQL form against DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from oracle import compare, duck  # noqa: E402

from pitfeat.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    report = compare(QUERIES[name](spark, "/root/testdata/sf0.01"), duck("/root/testdata/sf0.01"), ORACLES[name])
    assert report["equal"], report
