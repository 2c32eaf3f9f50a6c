"""Regression trees grown level by level, every step a relation.

Cuts of a feature are its exact quantiles.  The rows of a level are counted once per (node, feature, bin): rows, sum and
sum of squares of the label.  Running sums over the bins give both sides of every cut, and the cut that lowers
the squared error most is taken, ties to the first feature and the lowest cut.  Per level at most one row
for each node comes to the driver, and the tree is sent back as arrays within one expression.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storelens.operators.quantiles import exact_quantiles

BINS = 32


@dataclass
class LevelTree:
    """Nodes are numbered as in a heap: the root is 1, the children of i are 2 i (up to the cut) and 2 i + 1."""

    features: Sequence[str]
    cuts: list[list[float]]
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # node: feature, bin of the cut
    predictions: dict[int, float] = field(default_factory=dict)

    def bins(self) -> Column:
        """The row's bin in every feature: how many cuts lie below the value, all of them for a null."""

        def place(name: str, cuts: list[float]) -> Column:
            value = F.col(f"`{name}`").cast("double")
            below = F.filter(self._array(cuts, "double"), lambda cut: cut < value)
            return F.when(value.isNull(), len(cuts)).otherwise(F.size(below))

        return F.array(*[place(name, cuts) for name, cuts in zip(self.features, self.cuts, strict=True)])

    def node(self, bins: Column, depth: int) -> Column:
        """The node that a row reaches within ``depth`` steps."""
        last = 2**depth
        feature = self._array([self.splits.get(i, (-1, 0))[0] for i in range(last)], "int")
        cut = self._array([self.splits.get(i, (-1, 0))[1] for i in range(last)], "int")

        def step(at: Column, _: Column) -> Column:
            split = F.get(feature, at)
            below = F.get(bins, split) <= F.get(cut, at)
            return F.when((at >= last) | (split < 0), at).otherwise(at * 2 + F.when(below, 0).otherwise(1))

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), step) if depth else F.lit(1)

    def prediction(self, depth: int) -> Column:
        """The prediction of the tree cut back to ``depth``; the same tree serves all depths."""
        values = self._array([self.predictions.get(i, 0.0) for i in range(2 ** (depth + 1))], "double")
        return F.get(values, self.node(self.bins(), depth))

    def nodes(self) -> list[tuple[int, str, float, float]]:
        """Inner nodes: number, feature, cut and prediction."""
        return [(i, self.features[f], self.cuts[f][b], self.predictions[i]) for i, (f, b) in sorted(self.splits.items())]

    @staticmethod
    def _array(values: list, kind: str) -> Column:
        # Folded to one literal, however many nodes there are.
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def feature_cuts(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Different values at every ``1 / bins`` of each feature, the largest left out where it closes the range."""
    probabilities = [k / bins for k in range(1, bins)]
    return [sorted({float(v) for v in exact_quantiles(train, name, probabilities, discrete=True) if v is not None}) for name in features]


def fit_level_tree(train: DataFrame, label: str, features: Sequence[str], *, depth: int, bins: int = BINS, least_rows: int = 1) -> LevelTree:
    """Grow a tree (one aggregate over the rows per level, after those for the cuts); rows without a label take no part."""
    rows = train.where(F.col(label).isNotNull())
    centre = rows.agg(F.avg(F.col(label).cast("double"))).first()[0]
    if centre is None:
        raise ValueError("there are no rows to learn from")
    tree = LevelTree(tuple(features), feature_cuts(rows, features, bins))
    tree.predictions[1] = centre
    # Distances to the mean are summed, so that large labels do not cancel.
    held = rows.select(tree.bins().alias("bins"), (F.col(label).cast("double") - F.lit(centre)).alias("y"))
    growing = [1]
    for level in range(depth):
        at = tree.node(F.col("bins"), level)
        binned = held.withColumn("node", at).where(F.col("node").isin(growing)) if level else held.withColumn("node", F.lit(1))
        facts = binned.select("node", "y", F.posexplode("bins").alias("feature", "bin"))
        counts = facts.groupBy("node", "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
        growing = []
        for row in best_cuts(counts, least_rows).collect():
            tree.splits[row["node"]] = (row["feature"], row["bin"])
            for child, n, s in ((2 * row["node"], row["left_n"], row["left_s"]), (2 * row["node"] + 1, row["right_n"], row["right_s"])):
                tree.predictions[child] = centre + s / n
                growing.append(child)
        if not growing:
            break
    return tree


def best_cuts(counts: DataFrame, least_rows: int = 1) -> DataFrame:
    """The best cut of each node from rows ``n`` and label sums ``s`` by node, feature and bin."""
    upto = Window.partitionBy("node", "feature").orderBy("bin")
    whole = Window.partitionBy("node", "feature")
    sides = counts.select(
        "node", "feature", "bin", F.sum("n").over(upto).alias("left_n"), F.sum("s").over(upto).alias("left_s"),
        F.sum("n").over(whole).alias("all_n"), F.sum("s").over(whole).alias("all_s"),
    ).withColumns({"right_n": F.col("all_n") - F.col("left_n"), "right_s": F.col("all_s") - F.col("left_s")})
    possible = sides.where((F.col("left_n") >= least_rows) & (F.col("right_n") >= F.greatest(F.lit(least_rows), F.lit(1))))
    gain = (
        F.col("left_s") * F.col("left_s") / F.col("left_n") + F.col("right_s") * F.col("right_s") / F.col("right_n")
        - F.col("all_s") * F.col("all_s") / F.col("all_n")
    )
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("gain"), "feature", "bin"))
    return possible.withColumn("gain", gain).where("gain > 0").withColumn("place", place).where("place = 1").drop("place")


def depth_errors(tree: LevelTree, df: DataFrame, label: str, depths: Sequence[int]) -> DataFrame:
    """One row: the error of the tree cut back to each depth, all from one pass."""
    scored = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), *[tree.prediction(d).alias(f"p{d}") for d in depths])
    return scored.agg(*[F.sqrt(F.avg((F.col("y") - F.col(f"p{d}")) * (F.col("y") - F.col(f"p{d}")))).alias(f"rmse_depth_{d}") for d in depths])
