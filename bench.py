"""Benchmark the headline queries; prints ONE JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs, default 5, after warm-ups until two runs in a row
differ by under 15 percent, three at most), BENCH_EVENT_LOG=1 to
write Spark's event log (stage and task times) to a fresh /tmp folder. Each run executes the
whole plan into the no-op sink (no collect); the median of plan building and run
together is reported, with both parts apart, the rows read and written and the
number of shuffle exchanges planned.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyarrow.parquet as pq  # noqa: E402

from pitfeat.session import get_spark  # noqa: E402
from pitfeat.workloads import QUERIES  # noqa: E402

HEADLINE = {
    # query: tables it reads
    "rolling_7_14": ["orders"],
    "search_space_12": ["lineitem", "orders"],
    "lookup_asof_scd2": ["lineitem", "orders", "customer"],
    "training_set": ["lineitem", "orders", "customer", "supplier"],
    "lookup_asof_features": ["lineitem", "orders"],
    "window_closed_left": ["lineitem", "orders"],
    "dense_rollups": ["orders", "customer"],
    "training_set_defaults": ["lineitem", "orders", "customer", "supplier"],
}


def rows_in(sf_dir: str, tables) -> int:
    return sum(pq.ParquetFile(f"{sf_dir}/{t}.parquet").metadata.num_rows for t in tables)


def exchanges(df) -> int:
    """Shuffle exchanges in the physical plan as planned (AQE may still coalesce,
    convert joins to broadcast, or split skewed partitions at run time)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a reused subquery is printed at each reference: count distinct exchange ids
    ids = re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|"
                     r"RoundRobinPartitioning)[^\n]*?\[plan_id=(\d+)\]", plan)
    return len(set(ids))


def final_plan_stats(df) -> dict:
    """Run the frame's own adaptive plan once (JVM side, no rows to Python) and
    count the shuffle stages AQE actually ran, reused and broadcast."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    return {"shuffle_stages": len(set(re.findall(r"ShuffleQueryStage (\d+)", plan))),
            "reused_stages": plan.count("ReusedExchange") + plan.count("ReusedQueryStage"),
            "broadcast_stages": len(set(re.findall(r"BroadcastQueryStage (\d+)", plan)))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times from Spark's event log, written to a fresh scratch folder
        import tempfile
        log_dir = tempfile.mkdtemp(prefix="pitfeat-events-")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(2, 2 * cpus)))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=parts, app="pitfeat-bench",
                      extra_conf=extra)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    times, details = {}, {}
    for name, tables in HEADLINE.items():
        df, warm = None, []

        def once():
            nonlocal df
            t0 = time.perf_counter()  # building the plan counts
            df = QUERIES[name](spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return t1 - t0, time.perf_counter() - t1

        while len(warm) < 2 or len(warm) < 3 and abs(warm[-1] - warm[-2]) > 0.15 * warm[-1]:
            warm.append(sum(once()))
        parts_of = [once() for _ in range(runs)]
        samples = [a + b for a, b in parts_of]
        times[name] = round(statistics.median(samples), 3)
        details[name] = {"rows_in": rows_in(sf_dir, tables), "rows_out": QUERIES[name](spark, sf_dir).count(),
                         "planned_exchanges": exchanges(df), **final_plan_stats(QUERIES[name](spark, sf_dir)),
                         "plan_build_sec": round(statistics.median(a for a, _ in parts_of), 3),
                         "run_sec": round(statistics.median(b for _, b in parts_of), 3),
                         "runs": [round(s, 3) for s in samples]}
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf.group(1)) if sf else None,
                      "cpus": cpus, "details": details, "skew": skew_check(spark, sf_dir, runs),
                      "serving": serving_check(spark, sf_dir, runs)}))


def serving_check(spark, sf_dir: str, runs: int) -> dict:
    """One day of requests through the whole fraud feature spec: the small spine
    cuts every table to its keys before the shuffles."""
    from pitfeat.plans.training import apply_spec
    from pitfeat.sources.tables import Tables
    from pitfeat.specs import FeatureSpec
    from pitfeat.workloads import feature_tables, fraud_features, request_spine

    t = Tables(spark, sf_dir)
    req = request_spine(t)
    t0 = time.perf_counter()
    df = apply_spec(FeatureSpec("fraud", fraud_features(spark)), req, feature_tables(t))
    build = time.perf_counter() - t0
    samples = []
    for i in range(max(1, runs // 2) + 1):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        if i:
            samples.append(time.perf_counter() - t0)
    return {"requests": req.count(), "plan_build_sec": round(build, 3),
            "run_sec": round(statistics.median(samples), 3)}


def skew_check(spark, sf_dir: str, runs: int) -> dict:
    """Rollups and an as-of lookup on orders, as given and with a third of all
    orders moved onto one account (the hot-key case the plans must absorb)."""
    from pyspark.sql import functions as F

    from pitfeat.operators import lookup as L
    from pitfeat.operators import rolling as R
    from pitfeat.sources.tables import Tables

    o = Tables(spark, sf_dir).txn_orders()
    hot = o.withColumn("account_id", F.when(F.pmod("transaction_id", F.lit(3)) == 0, F.lit(7))
                       .otherwise(F.col("account_id")))
    spec = R.rolling_7_14_spec("account_id", "txn_date", "amount")

    def plans(facts):
        roll = R.aggregate_features(facts, spec, mode="facts")
        spine = facts.select(F.col("account_id").alias("k"), F.col("txn_date").alias("t"), "transaction_id")
        right = L.AsOfRight(roll, ["account_id"], "txn_date", ["7_day_total"])
        return {"rolling": roll, "asof": L.lookup_asof(spine, [right], "k", "t")}

    out = {}
    for label, facts in (("uniform", o), ("hot_key_third", hot)):
        for name, df in plans(facts).items():
            samples = []
            for i in range(max(1, runs // 2) + 1):
                t0 = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                if i:
                    samples.append(time.perf_counter() - t0)
            out[f"{name}_{label}"] = round(statistics.median(samples), 3)
    return out


if __name__ == "__main__":
    main()
