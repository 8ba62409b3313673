"""Write docs/plans.md: the physical plan trees of the headline queries at sf0.1.

python tests/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitfeat.session import get_spark  # noqa: E402
from pitfeat.workloads import QUERIES  # noqa: E402

HEADLINE = ["rolling_7_14", "search_space_12", "lookup_asof_scd2", "training_set", "training_set_defaults",
            "lookup_asof_features", "dense_rollups", "enrich_batch", "request_day"]


def summary(df) -> str:
    """The node tree of explain('formatted') plus each scan's pushed filters and read schema."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    scans = []
    for block in details.split("\n\n"):
        lines = block.strip().splitlines()
        if lines and "Scan parquet" in lines[0]:
            keep = [ln for ln in lines if ln.startswith(("(", "PushedFilters", "ReadSchema"))]
            scans.append("\n".join(keep))
    tree = re.sub(r"#\d+L?", "", tree)
    return tree.strip() + "\n\n" + "\n".join(scans)


def main(sf_dir: str) -> None:
    spark = get_spark(shuffle_partitions=16)
    out = ["# Physical plans of the headline queries",
           "",
           f"Generated by `python tests/dump_plans.py` at `{sf_dir}` (8 cores, 16 shuffle partitions, AQE on).",
           "Initial plans as planned; AQE may still coalesce partitions and turn small joins into broadcasts.",
           ""]
    for name in HEADLINE:
        df = QUERIES[name](spark, sf_dir)
        out += [f"## {name}", "", "```", summary(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
