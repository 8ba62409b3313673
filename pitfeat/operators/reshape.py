"""Reshaping helpers: flatten arrays of structs (U1, P2), table functions (U1), request structs."""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def flatten_array(df: DataFrame, column: str, keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """Explode an ``array<struct>`` column and lift the struct's fields to columns.

    ``keep`` columns of the row are repeated on every element; ``outer`` keeps
    rows whose array is empty or NULL (with NULL fields).
    """
    ex = F.explode_outer(column) if outer else F.explode(column)
    x = df.select(*keep, ex.alias("__e"))
    return x.select(*keep, "__e.*")


def request_struct(df: DataFrame, fields: Sequence[str] | None = None, name: str = "request") -> DataFrame:
    """Pack columns into one struct column (``struct(*)`` / ``named_struct``)."""
    cols = list(fields) if fields else df.columns
    return df.select(F.struct(*[F.col(c).alias(c) for c in cols]).alias(name))


def unpack_struct(df: DataFrame, name: str = "request") -> DataFrame:
    return df.select(f"{name}.*")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all cores: a scan's tasks follow its bytes, while per-row
    Python work follows its rows, so a small file of many rows would keep one core busy."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def register_row_function(spark: SparkSession, name: str, rows: Callable[..., list[tuple]], schema: Callable[..., StructType]) -> None:
    """Register a Python table function that turns each row's arguments into rows.

    ``rows(*values)`` returns a row's output rows; ``schema(*arguments)`` gives their type
    (a ``StructType``) at analysis time, from the arguments' types and constant values,
    so one function serves several shapes. SQL calls it per row:
    ``FROM t, LATERAL name(t.a, 3)``; arguments cross to Python in pickled batches. (With
    ``useArrow`` Spark makes an Arrow table of every call's few rows, which costs
    more than the call.)
    """
    class RowFunction:
        @staticmethod
        def analyze(*arguments: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(schema(*arguments))

        def eval(self, *values):
            yield from rows(*values)

    spark.udtf.register(name, F.udtf(RowFunction, useArrow=False))
