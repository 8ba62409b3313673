"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed per source, targets follow from the weights, and each source's
rate is target / size. A document is emitted floor(rate) times, plus once more
when a uniform number drawn from a hash of the seed, its id and its text lies
below the rate's fraction.

Targets: sources in code-point order, null last, weigh ``weights`` in turn and
share ``share`` times all sizes. A target stops at ``cap`` times its source's
size; the excess is shared anew by weight. The fixed point of that is a water
level L: target = min(cap * size, L * weight), where sources fill up in the order
of cap * size / weight, so running sums over that order give L in one pass.

Scale: one map-side combined aggregation to one row per source; the table of
sources is written, counted and, when small, broadcast, so documents are never
shuffled and a source with a third of all rows is no burden. Copies are made by
a narrow explode.

Defined results: a null text has size 0, an empty source target 0 and rate 0;
null is a source of its own; repeated rows with one id and text share their
draw; an empty table yields no rows; reruns agree, since nothing depends on the
order of rows. A rate never exceeds ``cap``, so with the whole number 2 no
document is taken more than twice.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, join_small, materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of seed, id and text."""
    text = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    hexed = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text).cast("binary"))
    return F.conv(F.substring(hexed, 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source (source, source_size): weight, target and rate; one row per source, null included."""
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("__k"), F.lit(len(weights))) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("__k", F.row_number().over(by_name) - 1).withColumn("weight", cycle)
    every = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("__full", F.col("source_size") * F.lit(float(cap)) / F.col("weight"))
    filling = Window.orderBy("__full", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    # if exactly the sources before this one are full, the level is what remains over the other weights
    level = ((F.lit(float(share)) * F.sum("source_size").over(every) - F.lit(float(cap)) * F.coalesce(F.sum("source_size").over(filling), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0))))
    s = s.withColumn("__level", level)
    # the water level is the one at the first source that it does not fill
    s = s.withColumn("__at", F.min(F.when(F.col("__level") < F.col("__full"), F.struct("__full", "__k", "__level"))).over(every)["__level"])
    target = F.when(F.col("__at").isNull(), F.col("source_size") * F.lit(float(cap))).otherwise(
        F.least(F.col("source_size") * F.lit(float(cap)), F.col("__at") * F.col("weight")))
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(cap)))).otherwise(F.lit(0.0))
    return s.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "weight", "target", "rate")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 29) -> DataFrame:
    """``docs`` with ``__copies`` (how often the mix takes the row) and its source's size and target."""
    sums = docs.select("source", n_words(F.col("text")).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size"))
    table = materialize(targets(sums, weights, share, cap), name="mix-sources")
    table = table.select(F.col("source").alias("__source"), F.col("source_size").alias("__source_size"),
                         F.col("target").alias("__target"), F.col("rate").alias("__rate"))
    out = join_small(docs, table, F.col("source").eqNullSafe(F.col("__source")))
    whole = F.floor("__rate")
    copies = whole + F.when(draw(seed) < F.col("__rate") - whole, F.lit(1)).otherwise(F.lit(0))
    return out.withColumn("__copies", copies.cast("int")).drop("__source", "__rate")


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with its own columns."""
    names = docs.columns
    mixed = mix(docs, **options).where(F.col("__copies") > 0)
    return (mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{n}`") for n in names]))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    m = mix(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text"), **options)
    size = n_words(F.col("text"))
    return m.select("doc_id", size.alias("size"), F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), (size * F.col("__copies")).alias("taken"))
