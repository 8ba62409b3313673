"""A decision tree from per-node histograms (M1, T6, T7): every split can be checked by SQL.

Each feature's range in the training set is cut into ``bins`` equal parts; a value's
bin is a plain expression, so the tree needs no pass of its own to find quantiles.
Level by level, one aggregate counts rows and positive labels per (node, feature,
bin), with map-side combining (its output is bounded by nodes x features x bins,
whatever the table's size); running sums over a node's bins give both children
of every possible split, and the one with the least gini impurity is taken, by
exact counts: ties go to the feature listed first, then to the lower bin. NULL is a
bin of its own below all others, so it needs no imputing. The driver holds the tree alone.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

NULL_BIN = -1


@dataclass
class BinnedTree:
    """Per feature its least value and bin width; per split node (feature, last bin that goes left); per leaf its rows and positives."""

    features: list[str]
    low: dict[str, float]
    width: dict[str, float]
    bins: int
    splits: dict[int, tuple[str, int]] = field(default_factory=dict)
    leaves: dict[int, tuple[int, int]] = field(default_factory=dict)

    def bin(self, f: str) -> Column:
        x = F.col(f).cast("double")
        if not self.width[f]:
            return F.when(x.isNull(), F.lit(NULL_BIN)).otherwise(F.lit(0))
        b = F.floor((x - F.lit(self.low[f])) / F.lit(self.width[f]))
        return F.when(x.isNull(), F.lit(NULL_BIN)).otherwise(F.greatest(F.lit(0), F.least(b, F.lit(self.bins - 1)))).cast("int")

    def node(self, at: int = 1) -> Column:
        """The leaf a row reaches; node n has the children 2n and 2n + 1."""
        if at not in self.splits:
            return F.lit(at)
        f, last = self.splits[at]
        return F.when(self.bin(f) <= last, self.node(2 * at)).otherwise(self.node(2 * at + 1))

    def score(self) -> Column:
        """The share of positives in a row's leaf; NULL for a tree without rows."""
        node, out = self.node(), None
        for n, (rows, positive) in sorted(self.leaves.items()):
            share = F.lit(positive / rows if rows else None).cast("double")
            out = F.when(node == n, share) if out is None else out.when(node == n, share)
        return F.lit(None).cast("double") if out is None else out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` and ``prediction`` (1 above one half)."""
        return df.withColumn("score", self.score()).withColumn("prediction", (F.col("score") > 0.5).cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self), sort_keys=True),)], "tree string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> BinnedTree:
        raw = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
        number = lambda d: {int(k): tuple(v) for k, v in d.items()}
        return BinnedTree(**{**raw, "splits": number(raw["splits"]), "leaves": number(raw["leaves"])})


def _purity(positive: Column, rows: Column) -> Column:
    """(positives^2 + negatives^2) / rows: the greater over both children, the less their gini impurity."""
    p, n = positive.cast("double"), rows.cast("double")
    return (p * p + (n - p) * (n - p)) / n


def fit_binned_tree(df: DataFrame, label: str, features: Sequence[str], max_depth: int = 5, bins: int = 32,
                    min_rows: int = 1, weight_col: str | None = None) -> BinnedTree:
    """A gini tree of ``max_depth`` levels on a 0/1 label (rows with a NULL label are left out).

    A node is split while both children hold at least ``min_rows`` rows and
    purity grows. ``weight_col`` (whole numbers) counts a row so many times (M4);
    NULL counts it once, ``min_rows`` counts weights.
    """
    weight = F.lit(1).cast("bigint") if weight_col is None else F.coalesce(F.col(weight_col).cast("bigint"), F.lit(1))
    features = list(features)
    data = materialize(df.where(F.col(label).isNotNull()).select((F.col(label).cast("long") * weight).alias("__y"), weight.alias("__n"), *[F.col(f).cast("double").alias(f) for f in features]),
                       name="binned-train")
    ends = data.agg(*[F.min(f).alias(f"a{i}") for i, f in enumerate(features)], *[F.max(f).alias(f"b{i}") for i, f in enumerate(features)]).first()
    low = {f: float(ends[f"a{i}"] or 0.0) for i, f in enumerate(features)}
    width = {f: (float(ends[f"b{i}"] or 0.0) - low[f]) / bins for i, f in enumerate(features)}
    tree = BinnedTree(features, low, width, bins)
    binned = data.select("__y", "__n", *[tree.bin(f).alias(f) for f in features])
    open_nodes = [1]
    for _ in range(max_depth):
        if not open_nodes:
            break
        best = _best_splits(binned, _walk(tree.splits), features, open_nodes, min_rows)
        for r in best.collect():  # a row an open node at most
            tree.splits[r["node"]] = (features[r["feature"]], int(r["bin"]))
        open_nodes = [c for n in open_nodes if n in tree.splits for c in (2 * n, 2 * n + 1)]
    counted = binned.groupBy(_walk(tree.splits).alias("node")).agg(F.sum("__n").alias("n"), F.sum("__y").alias("p"))
    tree.leaves = {r["node"]: (r["n"], r["p"]) for r in counted.collect()}
    return tree


def _walk(splits: dict[int, tuple[str, int]], at: int = 1) -> Column:
    """The node of a row whose features are bins already."""
    if at not in splits:
        return F.lit(at)
    f, last = splits[at]
    return F.when(F.col(f) <= last, _walk(splits, 2 * at)).otherwise(_walk(splits, 2 * at + 1))


def _best_splits(binned: DataFrame, node: Column, features: Sequence[str], open_nodes: Sequence[int], min_rows: int) -> DataFrame:
    """node, feature (its number) and bin of the best split of each open node."""
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f).alias("bin")) for i, f in enumerate(features)]))
    rows = binned.select(node.alias("node"), "__y", "__n", each.alias("s")).where(F.col("node").isin(list(open_nodes)))
    counts = rows.groupBy("node", "s.feature", "s.bin").agg(F.sum("__n").alias("n"), F.sum("__y").alias("p"))
    own = Window.partitionBy("node", "feature")
    upto = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select("node", "feature", "bin", F.sum("n").over(upto).alias("nl"), F.sum("p").over(upto).alias("pl"),
                         F.sum("n").over(own).alias("n"), F.sum("p").over(own).alias("p"))
    nr, pr = F.col("n") - F.col("nl"), F.col("p") - F.col("pl")
    sums = sums.where((F.col("nl") >= min_rows) & (nr >= F.lit(min_rows)) & (nr > 0))
    sums = sums.withColumn("purity", _purity(F.col("pl"), F.col("nl")) + _purity(pr, nr)).where(F.col("purity") > _purity(F.col("p"), F.col("n")))
    best = sums.groupBy("node").agg(F.max(F.struct("purity", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))).alias("m"))
    return best.select("node", (-F.col("m.f")).alias("feature"), (-F.col("m.b")).alias("bin"))
