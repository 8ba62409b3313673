"""Order-insensitive comparison of a Spark DataFrame with a DuckDB SQL result."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

from pitfeat.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def compare(df, con, sql: str, exact_float: bool = False) -> dict:
    """Return a report: columns, row counts, multiset equality, sample diffs."""
    s_cols = sorted(df.columns)
    rel = con.execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = rel.fetchall()
    s_rows = df.select(*s_cols).collect()
    order = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    norm = (lambda v: v) if exact_float else _norm
    sc = Counter(tuple(norm(r[c]) for c in s_cols) for r in s_rows)
    dc = Counter(tuple(norm(r[i]) for i in order) for r in d_rows)
    only_s = list((sc - dc).elements())[:5]
    only_d = list((dc - sc).elements())[:5]
    return {
        "columns_equal": s_cols == sorted(d_cols),
        "spark_columns": s_cols, "duck_columns": sorted(d_cols),
        "rows_spark": len(s_rows), "rows_duck": len(d_rows),
        "equal": s_cols == sorted(d_cols) and sc == dc,
        "only_spark": only_s, "only_duck": only_d,
    }
