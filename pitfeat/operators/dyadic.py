"""Sliding approximate distinct counts over long windows by aligned blocks of sketches (A5).

A frame of L granules over HLL sketches unions up to L of them per row. Here the
granules' sketches are unioned once into aligned blocks of STEP, STEP ** 2, .. granules
(one aggregate over (key, time bucket, level, block), within the tasks that have the groups), which
lie in the same (key, time bucket) group as the granules. A frame is then a few RANGE frames of the
window node that evaluates all else: its whole blocks of the highest level, and at both of
its ends the blocks of each lower level, at most 2 (STEP - 1) a level. They may overlap,
since a union counts nothing twice, but hold nothing from outside the frame. Work per point
grows with log L, and no sketch that was unioned for a point is shuffled or written.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..functions import aggregates as aggreg

G, FT, LEVEL = "__g", "__ft", "__level"
#: Granules of a block of level 1, and blocks of a level in one of the next.
STEP = 8


def _block(level: int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), number.alias("block"))


def blocks(low: Column, high: Column, levels: int) -> Column:
    """The aligned blocks (level, block) that tile granules low .. high."""
    found = []
    for k in range(levels + 1):
        size = F.lit(1 << k)
        # block bounds at this level: the first whole block, and the one after the last
        first, after = F.ceil(low / size).cast("bigint"), F.floor((high + 1) / size).cast("bigint")
        if k == levels:
            found.append(F.when(first < after, F.transform(F.sequence(first, after - 1), lambda b: _block(levels, b))))
        else:
            found.append(F.when((first < after) & (F.pmod(first, F.lit(2)) == 1), F.array(_block(k, first))))
            found.append(F.when((first < after) & (F.pmod(after, F.lit(2)) == 1), F.array(_block(k, after - 1))))
    nothing = F.array().cast("array<struct<level:int,block:bigint>>")
    return F.flatten(F.array(*[F.coalesce(f, nothing) for f in found]))


def levels_of(span: int) -> int:
    """The highest level whose blocks are no longer than ``span`` granules."""
    n = 0
    while STEP ** (n + 1) <= span:
        n += 1
    return n


def with_blocks(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], span: int) -> DataFrame:
    """``rows`` (one per key and granule) at level 0, and each level's blocks, at their last granule.

    A block has the union of its rows' sketches, is no evaluation point and has no other partial.
    """
    here = F.struct(F.lit(0).alias("level"), F.col(G).cast("bigint").alias("g"))
    above = [F.struct(F.lit(k).alias("level"), ((F.floor(F.col(G) / F.lit(STEP ** k)) + 1) * STEP ** k - 1).cast("bigint").alias("g"))
             for k in range(1, levels_of(span) + 1)]
    places = F.when(F.col(FT) == 1, F.array(here, *above)).otherwise(F.array(here))
    sketches = {aggreg.pname("hll", c) for c in columns}
    rest = [c for c in rows.columns if c not in {*keys, G, *sketches}]
    own = F.col("__e.level") == 0
    x = rows.withColumn("__e", F.explode(places)).select(
        *keys, F.col("__e.level").alias(LEVEL), F.col("__e.g").alias(G), *sketches,
        *[F.when(own | F.lit(c == FT), F.col(c)).alias(c) for c in rest])
    # level 0 has one row a group: its other columns pass as they are
    return x.groupBy(*keys, LEVEL, G).agg(*[F.hll_union_agg(c).alias(c) for c in sorted(sketches)], *[F.first(c).alias(c) for c in rest])


def distinct_count(column: str, place: WindowSpec, low: int, high: int, zone: int) -> Column:
    """The count over granules low .. high around a row; ``place`` orders level n by granule + n * ``zone``."""
    top = levels_of(high - low + 1)
    ends = [(top, low + STEP ** top - 1, high)]  # by the last granules of blocks inside the frame
    for k in range(top):
        size, above = STEP ** k, STEP ** (k + 1)
        ends += [(k, low + size - 1, low + above - 2), (k, high - above + size + 1, high)]
    parts = [F.hll_union_agg(aggreg.pname("hll", column)).over(place.rangeBetween(k * zone + a, k * zone + b)) for k, a, b in ends]
    whole = F.reduce(F.array(*parts), F.lit(None).cast("binary"),
                     lambda u, s: F.when(u.isNull(), s).when(s.isNull(), u).otherwise(F.hll_union(u, s)))
    return F.coalesce(F.hll_sketch_estimate(whole), F.lit(0)).cast("bigint")  # an empty window counts 0
