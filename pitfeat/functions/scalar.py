"""Scalar helpers, all built from JVM-side Column functions (no Python UDF)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..specs import DAY

EPOCH = "1970-01-01"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(c: str | Column) -> Column:
    """Days since 1970-01-01 of a date, timestamp or timestamp_ntz column."""
    return F.datediff(F.to_date(col_of(c)), F.lit(EPOCH).cast("date"))


def epoch_seconds(c: str | Column, dtype: str | None = None) -> Column:
    """Seconds since 1970-01-01 00:00.

    A TIMESTAMP_NTZ (or DATE) is a wall clock: its seconds are read from its
    fields, so the session time zone never shifts them. A TIMESTAMP is an
    instant: ``unix_seconds``.
    """
    c = col_of(c)
    if dtype == "date":
        return day_number(c).cast("bigint") * 86400
    if dtype == "timestamp_ntz":
        return (day_number(c).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
                + F.second(c)).cast("bigint")
    return F.unix_seconds(c.cast("timestamp"))


def granule(c: str | Column, granularity: _dt.timedelta = DAY, dtype: str | None = None) -> Column:
    """Integer granule number of a time column (floor division of the epoch)."""
    if granularity >= DAY:
        n = granularity // DAY
        d = day_number(c)
        return d if n == 1 else F.floor(d / F.lit(n)).cast("bigint")
    secs = int(granularity.total_seconds())
    return F.floor(epoch_seconds(c, dtype) / F.lit(secs)).cast("bigint")


def granule_start(g: str | Column, granularity: _dt.timedelta = DAY, dtype: str | None = None) -> Column:
    """Inverse of :func:`granule`: a date for day grains; for finer grains a
    timestamp of the same kind as the source (wall clock for TIMESTAMP_NTZ)."""
    g = col_of(g)
    if granularity >= DAY:
        n = granularity // DAY
        return F.date_add(F.lit(EPOCH).cast("date"), (g * F.lit(n)).cast("int"))
    secs = int(granularity.total_seconds())
    s = g * F.lit(secs)
    if dtype in ("timestamp_ntz", "date"):
        day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(s / 86400).cast("int"))
        sod = F.pmod(s, F.lit(86400))
        return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                    F.floor(sod / 3600).cast("int"), F.floor(F.pmod(sod, F.lit(3600)) / 60).cast("int"),
                                    F.pmod(sod, F.lit(60)).cast("decimal(8,6)"))
    return F.timestamp_seconds(s)


def ntz_to_instant(c: str | Column) -> Column:
    """A TIMESTAMP_NTZ wall clock read as UTC, as a TIMESTAMP instant.

    Unlike ``cast(.. as timestamp)`` the session time zone plays no part, so
    event-time windows align on UTC days wherever the job runs.
    """
    c = col_of(c)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def instant_to_ntz(c: str | Column) -> Column:
    """The UTC wall clock of a TIMESTAMP instant, as TIMESTAMP_NTZ (zone-free)."""
    u = F.unix_micros(col_of(c))
    day = F.date_add(F.lit(EPOCH).cast("date"), F.floor(u / 86_400_000_000).cast("int"))
    us = F.pmod(u, F.lit(86_400_000_000))
    return F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day),
                                F.floor(us / 3_600_000_000).cast("int"),
                                F.floor(F.pmod(us, F.lit(3_600_000_000)) / 60_000_000).cast("int"),
                                (F.pmod(us, F.lit(60_000_000)) / 1_000_000).cast("decimal(8,6)"))


def years_365(start: str | Column, end: str | Column) -> Column:
    """Whole 365-day years between two dates (F10): not calendar years."""
    return F.floor(F.datediff(F.to_date(col_of(end)), F.to_date(col_of(start))) / F.lit(365)).cast("bigint")


# Fixed value: Park-Miller "minimal standard" generator, modulus 2^31 - 1 and
# multiplier 48271. Integer arithmetic only, so every engine gets the same split.
SPLIT_MODULUS = 2147483647
SPLIT_MULTIPLIER = 48271


def split_bucket(key: str | Column, seed: int = 0, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) of an integer key, independent of partitioning (M2).

    For keys of other types see ``split_bucket_text``.
    """
    k = F.pmod(col_of(key).cast("bigint") + F.lit(seed), F.lit(SPLIT_MODULUS))
    h = F.pmod(k * F.lit(SPLIT_MULTIPLIER), F.lit(SPLIT_MODULUS))
    return F.pmod(h, F.lit(buckets))


def split_bucket_text(key: str | Column, seed: int = 0, buckets: int = 10000) -> Column:
    """Stable bucket in [0, buckets) of a key by the MD5 of its text (52 bits of it); NULL for a NULL key."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), col_of(key).cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint"), F.lit(buckets))


# Fixed values of the test fixture's deterministic stand-in for the random
# placeholder distance (FIXTURES.md): 1 + (7919*a + 104729*b) % 250.
DISTANCE_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION {name}(from_zone BIGINT, to_zone BIGINT) "
    "RETURNS DOUBLE RETURN CAST(1 + pmod(7919 * from_zone + 104729 * to_zone, 250) AS DOUBLE)"
)


def register_distance(spark: SparkSession, name: str = "distance") -> str:
    """Register the fixture's distance as a SQL function; Catalyst inlines it."""
    spark.sql(DISTANCE_SQL.format(name=name))
    return name
