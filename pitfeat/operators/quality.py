"""Key validation jobs: what ``NOT NULL`` / ``PRIMARY KEY`` declarations promise
but parquet cannot enforce (S11-S14). Each returns the violations as a
DataFrame; an empty result means the declaration holds.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import TableSpec


def _ls(v) -> list[str]:
    return [v] if isinstance(v, str) else list(v)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: (column_name, null_rows, total_rows), in one scan."""
    cols = _ls(columns)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.col(c).isNull().cast("bigint")).alias(f"__z{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                           F.coalesce(F.col(f"__z{i}"), F.lit(0).cast("bigint")).alias("null_rows"))
                                  for i, c in enumerate(cols)]))
    return agg.select(stacked.alias("__s"), F.col("__n").alias("total_rows")) \
        .select("__s.column_name", "__s.null_rows", "total_rows")


def validate_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows violating NOT NULL on any of ``columns``."""
    cols = _ls(columns)
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def validate_unique(df: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``."""
    keys = _ls(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def validate_spec(df: DataFrame, spec: TableSpec) -> dict[str, DataFrame]:
    """All checks a ``TableSpec`` implies: duplicate primary keys, NULL key parts."""
    spec.validate(df.columns)
    nn = list(dict.fromkeys(list(spec.primary_key) + list(spec.not_null)))
    return {"unique": validate_unique(df, list(spec.primary_key)),
            "not_null": validate_not_null(df, nn)}


def orphans(facts: DataFrame, fk: Sequence[str] | str, dim: DataFrame,
            key: Sequence[str] | str) -> DataFrame:
    """Fact rows whose non-NULL foreign key has no row in ``dim``.

    A LEFT ANTI join: AQE broadcasts the dimension when its measured size is
    small, and shuffles both sides otherwise.
    """
    fks, ks = _ls(fk), _ls(key)
    # no distinct: duplicate dimension keys cannot change an anti join, and
    # deduplicating would cost a shuffle of the dimension
    d = dim.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(ks)])
    cond = None
    for i, f in enumerate(fks):
        c = facts[f] == d[f"__d{i}"]
        cond = c if cond is None else cond & c
    nonnull = facts
    for f in fks:
        nonnull = nonnull.where(F.col(f).isNotNull())
    return nonnull.join(d, cond, "left_anti")


def validate_versions(df: DataFrame, key: Sequence[str] | str, valid_from: str, valid_to: str,
                      order_by: Sequence[str] = ()) -> DataFrame:
    """SCD-2 versions that overlap the next version of their key.

    A version is bad when it is open (``valid_to`` NULL) yet not the last, or
    when it ends after the next version starts. Interval and as-of lookups
    agree exactly when this is empty. Runs on the bucketed ``lead`` of
    ``scd.next_time``, so one key with a huge history does not land in one task.
    """
    from .scd import next_time

    nx = next_time(df, key, valid_from, order_by)
    bad = (F.col("__next").isNotNull()
           & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col("__next"))))
    return nx.where(bad).withColumnRenamed("__next", "next_valid_from")
