"""Spark session defaults and the shared folder used to cut lineage.

Nothing here is required by the operators: they only build lazy DataFrames on
whatever session the caller owns. ``get_spark`` is the profile used by tests,
``bench.py`` and the examples; the cluster profile in the README scales the
same knobs up.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_OWN: dict[str, str] = {}  # application id -> the folder made for it


def _driver_memory() -> str:
    """Half of physical memory, between 2 and 16 GB (local mode: the driver is the executor)."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    gb = max(2, min(16, int(total / 2**30 / 2)))
    return f"{gb}g"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pitfeat", extra_conf: dict | None = None) -> SparkSession:
    """Local session with AQE on, UTC clock, UI off (no server is opened)."""
    master = master or os.environ.get("PITFEAT_MASTER", "local[8]")
    if shuffle_partitions is None:
        shuffle_partitions = int(os.environ.get("PITFEAT_SHUFFLE_PARTITIONS", "8"))
    builder = SparkSession.builder.master(master)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PITFEAT_DRIVER_MEMORY", _driver_memory()))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage-cut folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it to a shared folder and we
    only read it. Only where it is unset and the master is local (one machine)
    do we make our own; elsewhere executors would not see each other's files.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or _OWN.get(spark.conf.get("spark.app.id", ""))
    if not path:
        path = own_folder(spark.conf.get("spark.master", ""))
        _OWN[spark.conf.get("spark.app.id", "")] = path
    try:
        spark.sparkContext.setCheckpointDir(path)  # for DataFrame.checkpoint() and Spark ML
    except Exception:  # e.g. a Spark Connect session has no SparkContext; written tables still work
        pass
    return path


def own_folder(master: str) -> str:
    """A folder of our own, for a local master only."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share (master {master!r})")
    return tempfile.mkdtemp(prefix="pitfeat-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, path: str | None = None, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    This cuts lineage with a written table, so that a non-deterministic input is
    evaluated exactly once (H13) and a lost executor re-reads files instead of
    recomputing the whole plan.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_profile(shuffle_bytes: float, executors: int, cores_per_executor: int,
                    partition_bytes: int = 256 * 2**20,
                    broadcast_bytes: int = 64 * 2**20) -> dict[str, str]:
    """Settings for a cluster run, sized from the expected shuffle volume.

    ``spark.sql.shuffle.partitions`` is the larger of "about ``partition_bytes``
    per reducer" and three waves of tasks, so reducers fit in executor memory
    without spilling much; AQE then coalesces small partitions and splits
    skewed ones at run time. Broadcasts are decided by AQE from measured
    sizes, capped at ``broadcast_bytes``.
    """
    slots = max(1, executors * cores_per_executor)
    parts = max(int(shuffle_bytes // partition_bytes) + 1, 3 * slots)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
