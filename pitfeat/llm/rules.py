"""Quality rules with robust multivariate outliers, with DataFrame functions only.

Base statistics of the whole text feed fixed limits. The method then rejects
outliers: per language and source a minimum-covariance-determinant estimate of
five transformed statistics, and rejection by Mahalanobis distance.

Transformed statistics (shrunk or bounded, so that short texts don't stray):
log words; log mean word length with 60 words of prior; log share of symbols;
log share of repeated lines; arcsine root of the share of repeated words.

Estimate: three deterministic starts about the medians, scaled by quartile ranges:
no correlation, the covariance of squashed deviations (tanh), and that of spatial signs
(deviations of length one). From each, take the three quarters of the rows nearest to
the centre, compute their mean and covariance, and repeat (concentration steps)
while the determinant falls; the start with the least determinant wins. A
floor on each statistic's deviation, part of the determinant, keeps statistics that are
constant in a group from rejecting small departures. Finally distances are scaled so that their median is
that of a chi-square with five degrees of freedom. Groups with under
``min_rows`` rows take their language's estimate, then that of all rows; with too
few rows there as well, nothing is rejected.

Scale: text statistics are narrow array expressions, each window found twice is
counted by sorting (hash, position), linear but for the sort; every step is a
map-side combined aggregation over seven numbers per row, so a hot group splits;
all starts take a step in the same aggregation, and only groups whose determinant
still falls take another; the table of groups is broadcast after its rows are
counted. The driver gets one number a step. Very long texts are one row's arrays. No Python runs.

Defined results: null and empty texts have zeros, fail the base and stay out of
the estimate; null language or source is a group of its own; repeated rows count
each; an empty table yields no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_small, materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
DIM = 5
#: Least deviation of each transformed statistic. The last is under a sixth of what the
#: base rule leaves, asin(sqrt(0.3)) = 0.58, so that repeated words can reject alone.
FLOORS = (0.5, 0.06, 0.5, 0.35, 0.09)
#: Chi-square with five degrees of freedom: median, and the upper millionth (rejection).
MEDIAN_5, CUTOFF = 4.351, 36.0
KEEP = 0.75
ACCURACY = 10_000


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of each whole text."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                    F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    bare = F.length(F.translate("text", SPACES, ""))
    symbols = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    d = d.select("doc_id", "lang", "source", bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
                 lines.alias("__lines"), F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("__w"))
    windows = F.when(F.size("__w") >= 8, F.transform(F.sequence(F.lit(1), F.size("__w") - 7),
                                                       lambda i: F.xxhash64(F.slice("__w", i, 8)))).otherwise(F.array().cast("array<bigint>"))
    d = d.select("doc_id", "lang", "source", "word_chars", "n_symbols", F.size("__w").cast("long").alias("n_words"),
                 F.size("__lines").cast("long").alias("n_lines"),
                 (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"), windows.alias("__h"))
    # sorted (hash, position): a window found twice or more stands next to its like
    found = F.when(F.size(F.array_distinct("__h")) < F.size("__h"),
                   F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.withColumn("__s", found).drop("__h")
    at = lambda j: F.get("__s", j)["h"]
    twice = F.filter(F.transform("__s", lambda x, j: F.when((x["h"] == at(j - 1)) | (x["h"] == at(j + 1)), x["i"])), lambda i: i.isNotNull())
    d = d.withColumn("__p", F.sort_array(twice)).drop("__s")
    covered = F.aggregate(F.transform("__p", lambda p, j: F.least(F.lit(8), F.coalesce(F.get("__p", j + 1) - p, F.lit(8)))),
                          F.lit(0).cast("long"), lambda s, x: s + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__p")


def _transformed() -> list[Column]:
    n = F.col("n_words").cast("double")
    return [F.log1p(n), F.log((F.col("word_chars") + 360.0) / (n + 60.0)), F.log1p(100.0 * F.col("n_symbols") / (n + 100.0)),
            F.log1p(10.0 * F.col("n_dup_lines") / (F.col("n_lines") + 10.0)),
            F.asin(F.sqrt(F.when(n > 0, F.least(F.col("n_repeat_words") / n, F.lit(1.0))).otherwise(0.0)))]


X = [f"x{i}" for i in range(DIM)]


def _distance(d: DataFrame) -> Column:
    """Squared Mahalanobis distance from the columns m0.. and the Cholesky factor l00..; forward substitution."""
    z: list[Column] = []
    for i in range(DIM):
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * F.col(f"z{j}")
        z.append((f"z{i}", v / F.col(f"l{i}{i}")))
    for name, v in z:
        d = d.withColumn(name, v)
    return d.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, DIM)), F.col("z0") * F.col("z0"))).drop(*[f"z{i}" for i in range(DIM)])


def _factor(g: DataFrame) -> DataFrame:
    """Columns l_ij of the Cholesky factor of the covariance c_ij with floors on its diagonal."""
    for i in range(DIM):
        for j in range(i + 1):
            v = F.col(f"c{i}{j}")
            if i == j:
                v = v + F.lit(FLOORS[i] ** 2)
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            g = g.withColumn(f"l{i}{j}", F.sqrt(v) if i == j else v / F.col(f"l{j}{j}"))
    return g


PARAMS = [f"m{i}" for i in range(DIM)] + [f"l{i}{j}" for i in range(DIM) for j in range(i + 1)]


def _key(level: int, lang: str, source: str) -> Column:
    """One text per group; null differs from every name."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("null"))
    return F.concat_ws("\x1f", F.lit(str(level)), *([name(lang)] * (level > 0)), *([name(source)] * (level > 1)))


#: A determinant that falls by less than this share has settled.
SETTLED = 1e-6


def _covariance(df: DataFrame, scaled: bool) -> DataFrame:
    """c_ij from means a_i and mean products b_ij, in units of the deviations d_i if ``scaled``."""
    for i in range(DIM):
        for j in range(i + 1):
            c = F.col(f"b{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}")
            df = df.withColumn(f"c{i}{j}", c * F.col(f"d{i}") * F.col(f"d{j}") if scaled else c)
    return df


def _determinant() -> Column:
    out = F.pow(F.col("l00"), F.lit(2.0))
    for i in range(1, DIM):
        out = out * F.pow(F.col(f"l{i}{i}"), F.lit(2.0))
    return out


def starts(rows: DataFrame) -> DataFrame:
    """Per group g of rows (g, x0..) and start s: n, location m_i, factor l_ij."""
    quart = [F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), ACCURACY).alias(f"q{i}") for i, x in enumerate(X)]
    g = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *quart)
    g = materialize(g.select("g", "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(DIM)],
                             *[F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])).alias(f"d{i}") for i in range(DIM)]), name="mcd-quartiles")
    z = [(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"d{i}") for i in range(DIM)]
    size = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    sign = [F.when(size > 0, v / size).otherwise(F.lit(0.0)) for v in z]
    squashed = [F.tanh(v) for v in z]
    own = ["n", *[f"m{i}" for i in range(DIM)], *[f"d{i}" for i in range(DIM)]]
    sums = [F.avg(v[i] * v[j]).alias(f"{k}{i}{j}") for k, v in (("t", squashed), ("u", sign)) for i in range(DIM) for j in range(i + 1)]
    means = [F.avg(squashed[i]).alias(f"a{i}") for i in range(DIM)]
    joined = join_small(rows, g.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g"), "inner")
    moments = materialize(joined.groupBy("g", *own).agg(*means, *sums), name="mcd-moments")
    zero, out = F.lit(0.0), None
    for s, (mean, product) in enumerate([(lambda i: zero, lambda i, j: F.lit(float(i == j))),
                                         (lambda i: F.col(f"a{i}"), lambda i, j: F.col(f"t{i}{j}")),
                                         (lambda i: zero, lambda i, j: F.col(f"u{i}{j}") * F.lit(float(DIM)))]):
        one = moments.select("g", *own, F.lit(s).alias("s"), *[mean(i).alias(f"a{i}") for i in range(DIM)],
                             *[product(i, j).alias(f"b{i}{j}") for i in range(DIM) for j in range(i + 1)])
        one = _factor(_covariance(one, scaled=True)).select("g", "s", "n", *PARAMS)
        out = one if out is None else out.unionByName(one)
    return materialize(out, name="mcd-start")


def _concentrate(rows: DataFrame, g: DataFrame) -> DataFrame:
    """One step of every (g, s): mean and factor of the rows nearest to its centre, and their determinant."""
    y = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(DIM)]  # about the last centre, so that sums stay small
    aggs = [F.avg(y[i]).alias(f"a{i}") for i in range(DIM)] + [F.avg(y[i] * y[j]).alias(f"b{i}{j}") for i in range(DIM) for j in range(i + 1)]
    moved = _nearest(rows, g).groupBy("g", "s", "n", *[f"m{i}" for i in range(DIM)]).agg(*aggs)
    moved = _factor(_covariance(moved, scaled=False))
    for i in range(DIM):
        moved = moved.withColumn(f"m{i}", F.col(f"m{i}") + F.col(f"a{i}"))
    return moved.select("g", "s", "n", *PARAMS, _determinant().alias("det"))


def estimates(rows: DataFrame, steps: int = 25) -> DataFrame:
    """Per group g of rows (g, x0..): n, location m_i, factor l_ij, least determinant and distance scale.

    ``steps`` bounds the concentration steps; they end when no determinant falls.
    """
    moving, done = materialize(_concentrate(rows, starts(rows)), name="mcd-step"), None
    for _ in range(steps - 1):
        old = moving.select(F.col("g").alias("__g"), F.col("s").alias("__s"), F.col("det").alias("__det"))
        new = _concentrate(rows, moving.drop("det")).join(old, (F.col("g") == F.col("__g")) & (F.col("s") == F.col("__s")))
        new = materialize(new.drop("__g", "__s"), name="mcd-step")
        falls = F.col("det") < F.col("__det") * (1 - SETTLED)
        fallen = new.where(falls).select("g", "s")
        still = moving.join(fallen, ["g", "s"], "left_anti").unionByName(new.where(~falls & (F.col("det") < F.col("__det"))).drop("__det"))
        done = materialize(still if done is None else done.unionByName(still), name="mcd-settled")
        moving = materialize(new.where(falls).drop("__det"), name="mcd-step")
        if moving.isEmpty():
            break
    every = moving if done is None else done.unionByName(moving)
    best = F.min_by(F.struct("n", *PARAMS, "det"), F.struct("det", "s")).alias("b")
    g = every.groupBy("g").agg(best).select("g", *[F.col(f"b.{c}").alias(c) for c in ("n", *PARAMS, "det")])
    g = materialize(g, name="mcd-best")
    half = _with_distance(rows, g).groupBy("g").agg(F.percentile_approx("d2", 0.5, ACCURACY).alias("half"))
    return materialize(g.join(half, "g").withColumn("scale", F.greatest(F.col("half") / F.lit(MEDIAN_5), F.lit(1.0))).drop("half"), name="mcd")


def _with_distance(rows: DataFrame, g: DataFrame) -> DataFrame:
    return _distance(join_small(rows, g.withColumnRenamed("g", "__g"), F.col("g") == F.col("__g"), "inner"))


def _nearest(rows: DataFrame, g: DataFrame) -> DataFrame:
    """Per group and start, the three quarters of the rows nearest to its centre."""
    d = _with_distance(rows, g)
    limit = d.groupBy("g", "s").agg(F.percentile_approx("d2", KEEP, ACCURACY).alias("__most"))
    limit = materialize(limit.select(F.col("g").alias("__of"), F.col("s").alias("__from"), "__most"), name="mcd-limit")
    return join_small(d, limit, (F.col("g") == F.col("__of")) & (F.col("s") == F.col("__from")), "inner").where(F.col("d2") <= F.col("__most"))


def judge(docs: DataFrame, min_rows: int = 200, least_rows: int = 30, cutoff: float = CUTOFF, steps: int = 25) -> DataFrame:
    """Base statistics, base_failed, distance (squared; null where not estimated) and kept per document."""
    base = with_base(docs)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    base = base.withColumn("base_failed", failed)
    for x, v in zip(X, _transformed(), strict=True):
        base = base.withColumn(x, v)
    base = materialize(base, name="rules-stats")
    level = F.explode(F.array(*[_key(i, "lang", "source") for i in range(3)]))
    rows = base.where(~F.col("base_failed")).select(level.alias("g"), *X)
    g = estimates(rows, steps)
    own = base.where(~F.col("base_failed")).select(*[_key(i, "lang", "source").alias(f"k{i}") for i in range(3)]).distinct()
    best = own
    for i, least in ((2, min_rows), (1, min_rows), (0, least_rows)):
        part = g.where(F.col("n") >= least).select(F.col("g").alias(f"k{i}"), F.struct(*PARAMS, "scale").alias(f"p{i}"))
        best = best.join(part, f"k{i}", "left")
    best = best.select(F.col("k2").alias("__k"), F.coalesce("p2", "p1", "p0").alias("p"))
    best = materialize(best.select("__k", *[F.col(f"p.{c}").alias(c) for c in (*PARAMS, "scale")]), name="rules-groups")
    out = _distance(join_small(base, best, (_key(2, "lang", "source") == F.col("__k")) & ~F.col("base_failed")))
    distance = F.col("d2") / F.col("scale")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      distance.alias("distance"), (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= F.lit(cutoff))).alias("kept"))
