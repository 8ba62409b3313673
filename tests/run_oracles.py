"""Run registered queries against their DuckDB oracles: python tests/run_oracles.py [names...]"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitfeat.session import get_spark  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def main(argv):
    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    spark = get_spark()
    if os.environ.get("ORACLE_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["ORACLE_TZ"])
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv or sorted(qs)
    bad = equal = rows_only = 0
    for n in names:
        t0 = time.time()
        try:
            df = qs[n](spark, sf)
            if n not in sqls:
                cnt = df.count()
                rows_only += 1
                print(json.dumps({"query": n, "rows_only": cnt, "sec": round(time.time() - t0, 2)}))
                continue
            rep = compare(df, con, sqls[n], exact_float=os.environ.get("EXACT") == "1")
        except Exception as e:  # report and go on
            bad += 1
            print(json.dumps({"query": n, "error": repr(e)[:2000]}))
            continue
        rep["sec"] = round(time.time() - t0, 2)
        rep["query"] = n
        if rep["equal"]:
            equal += 1
            print(json.dumps({"query": n, "equal": True, "rows": rep["rows_spark"], "sec": rep["sec"]}))
        else:
            bad += 1
            print(json.dumps(rep, default=str))
    print(f"summary: {equal} equal to their oracle, {rows_only} rows-only, {bad} failed")
    print("FAILED" if bad else "ALL EQUAL", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
