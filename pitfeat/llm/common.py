"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from typing import Any, Callable, Hashable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["WORD", "SPACE_BYTES", "documents", "keep_columns", "materialize", "crc_text", "join_small", "rows_batch", "place",
           "worker_tables"]

#: A word: a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = (9, 10, 11, 12, 13, 32)

#: Rows up to which a per-group table is broadcast; beyond it the join shuffles.
SMALL_ROWS = 100_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_text(c: Column | str) -> Column:
    """Unsigned CRC-32 of a string's UTF-8 bytes, as long."""
    return F.crc32(F.col(c).cast("binary") if isinstance(c, str) else c.cast("binary"))


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


def join_small(left: DataFrame, small: DataFrame, on: Column, how: str = "left", rows: int = SMALL_ROWS) -> DataFrame:
    """Join a small stored table; broadcast only after its rows are counted.

    ``small`` must be a written table, so that the count reads file footers.
    Beyond ``rows`` Spark's own choice (a shuffled join that AQE splits at hot
    keys) takes over, with the same result.
    """
    return left.join(F.broadcast(small) if small.count() <= rows else small, on, how)


def rows_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def place(names: Sequence[str], name: str) -> int:
    """Where a column stands; names compare as Spark compares them."""
    return [n.lower() for n in names].index(name)


_TABLES: dict[Hashable, Any] = {}


def worker_tables(key: Hashable, make: Callable[[], Any]) -> Any:
    """What an operator keeps in a Python worker between tasks (a model, a tokenizer, caches of words).

    Spark uses a worker for one stage after the other, so only one operator's
    tables are held: asking for another's drops them and gives the memory back.
    """
    if key not in _TABLES:
        _TABLES.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)
        _TABLES[key] = make()
    return _TABLES[key]
