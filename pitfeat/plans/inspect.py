"""Plan inspection: what a query will shuffle, broadcast and read.

Built on ``DataFrame.explain("formatted")``, so it reports the plan Catalyst
chose (before AQE's run-time changes) without running the query.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def formatted_plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan_report(df: DataFrame) -> dict:
    """Counts of shuffles, broadcasts, windows, joins and scans, plus each
    scan's pushed filters and read schema."""
    text = formatted_plan(df)
    tree = text.split("\n\n\n", 1)[0]
    scans = []
    for block in text.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and re.match(r"\(\d+\) Scan parquet", lines[0]):
            info = {ln.split(":", 1)[0]: ln.split(":", 1)[1].strip() for ln in lines[1:] if ":" in ln}
            scans.append({"pushed_filters": info.get("PushedFilters", ""),
                          "read_schema": info.get("ReadSchema", ""),
                          "location": info.get("Location", "")})
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange \(\d+\)", tree)),
        "windows": len(re.findall(r"Window \(\d+\)", tree)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", tree)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", tree)),
        "python_nodes": len(re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)",
                                       tree)),
        "scans": scans,
    }
