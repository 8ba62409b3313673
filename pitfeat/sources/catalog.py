"""Catalog and sink helpers (S2-S8, S10): thin, explicit wrappers over the
DataFrame writer and Spark SQL, so pipelines name their tables in one place.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """Small driver-side rows with an explicit schema (S2); never for bulk data."""
    return spark.createDataFrame(list(rows), schema)


def ensure_schema(spark: SparkSession, name: str, use: bool = True) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` and optionally ``USE`` it."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def list_tables(spark: SparkSession, schema: str | None = None) -> list[str]:
    """Names of the tables and views of a schema."""
    return [t.name for t in spark.catalog.listTables(schema)]


def save_table(df: DataFrame, name: str, mode: str = "overwrite",
               partition_by: Sequence[str] = (), path: str | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Write a table, replacing data and schema on overwrite.

    With ``path`` the table is plain parquet files (read back with
    ``spark.read.parquet``); otherwise it is registered in the session catalog.
    ``partition_by`` (e.g. a month column) lets later filters prune folders.
    ``bucket_by=(n, keys)`` writes a catalog table hash-bucketed and sorted by
    its keys: joins on those keys against it then need no shuffle on its side
    (set ``path`` to place the files in shared storage).
    """
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif path:
        w.save(path)
    else:
        w.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Named temporary view (S8): Catalyst inlines it into every query using it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def input_example(df: DataFrame, n: int = 2, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a deterministic order (S10); a top-n, not a scan cap."""
    cols = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)
