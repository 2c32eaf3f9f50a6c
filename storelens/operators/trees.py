"""Rating prediction by regression trees, with depth tuning on a hold-out part."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.stats import root_mean_square

# Fixed values of the task: plain depth, and the depths tried when tuning.
DEPTH = 5
DEPTHS = (5, 7, 9, 12)
TRAIN_PERCENT = 75


@dataclass(frozen=True)
class Tuning:
    depth: int
    valid_rmse: dict[int, float]
    model: DecisionTreeRegressionModel


def split_by_key(
    df: DataFrame, *keys: str, percent: int = TRAIN_PERCENT, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts by a hash of the seed and the key columns.

    The part of a row depends on its key only, so it is the same on every run and
    after any repartitioning, and rows with equal keys stay together.  Splitting
    a part again needs another seed, since its hashes all lie on one side.
    """
    place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(100))
    return df.where(place < percent), df.where(place >= percent)


def rmse(df: DataFrame, label: str = "overall", prediction: str = "prediction", name: str = "rmse") -> DataFrame:
    """Root mean squared error as one row."""
    return df.agg(root_mean_square(F.col(label) - F.col(prediction)).alias(name))


def fit_tree(
    train: DataFrame, *, depth: int = DEPTH, label: str = "overall", features: str = "features", seed: int = 42
) -> DecisionTreeRegressionModel:
    return _tree(depth, label, features, seed).fit(train.select(features, label))


def _tree(depth: int, label: str, features: str, seed: int) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        maxDepth=depth, labelCol=label, featuresCol=features, predictionCol=f"depth_{depth}", seed=seed
    )


def tree_rmse(
    train: DataFrame, test: DataFrame, *, depth: int = DEPTH, label: str = "overall", features: str = "features"
) -> DataFrame:
    """Fit on one part, score the other: one row ``test_rmse``."""
    model = fit_tree(train, depth=depth, label=label, features=features)
    return rmse(model.transform(test), label, f"depth_{depth}", "test_rmse")


def best_candidate(metrics: DataFrame, metric: str, *order: str) -> DataFrame:
    """The row with the lowest metric; ties go to the first in the given order."""
    return metrics.where(F.col(metric).isNotNull()).orderBy(metric, *order).limit(1)


def leaf_paths(model: DecisionTreeRegressionModel) -> list[str]:
    """For each leaf, in the model's order, the steps from the root: L or R."""
    paths: list[str] = []
    steps: list[str] = []
    for line in model.toDebugString.splitlines()[1:]:
        found = re.match(r"( *)(If|Else|Predict)\b", line)
        if not found:
            continue
        if found[2] == "Predict":
            paths.append("".join(steps[: len(found[1]) - 2]))
        else:
            del steps[len(found[1]) - 2 :]
            steps.append("L" if found[2] == "If" else "R")
    return paths


def prefix_errors(
    model: DecisionTreeRegressionModel, train: DataFrame, valid: DataFrame, depths: Sequence[int], label: str = "overall"
) -> dict[int, float | None]:
    """Error on ``valid`` of the tree cut back to each depth (one aggregate over each part).

    Only sums by leaf are gathered, at most one row per leaf: a node of the cut tree predicts the mean label of the
    training rows below it.  Labels are taken as distances from the training mean, so that large ones do not cancel.
    """
    paths = leaf_paths(model)
    y = F.col(label).cast("double") - F.lit(train.agg(F.avg(label)).first()[0])

    def by_leaf(rows: DataFrame) -> dict[int, tuple[int, float, float]]:
        placed = model.copy({model.leafCol: "_leaf"}).transform(rows).groupBy("_leaf")
        sums = placed.agg(F.count(y).alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q"))
        return {int(row["_leaf"]): (row["n"], row["s"], row["q"]) for row in sums.collect() if row["n"]}

    learned, held_out = by_leaf(train), by_leaf(valid)
    total = sum(n for n, _, _ in held_out.values())
    errors: dict[int, float | None] = {}
    for depth in depths:
        nodes: dict[str, list[float]] = {}
        for leaf, (n, s, _) in learned.items():
            node = nodes.setdefault(paths[leaf][:depth], [0.0, 0.0])
            node[0], node[1] = node[0] + n, node[1] + s
        lost = 0.0
        for leaf, (n, s, q) in held_out.items():
            guess = nodes[paths[leaf][:depth]][1] / nodes[paths[leaf][:depth]][0]
            lost += q - 2 * guess * s + n * guess * guess
        errors[depth] = math.sqrt(max(lost, 0.0) / total) if total else None
    return errors


def tune_depth(
    train: DataFrame,
    *split_keys: str,
    depths: Sequence[int] = DEPTHS,
    label: str = "overall",
    features: str = "features",
    parallelism: int = 1,
    seed: int = 42,
) -> Tuning:
    """Choose the depth by hold-out error and refit it on all training rows.

    The rows are split by key hash (with ``seed``, which must differ from that of
    an earlier split by the same keys).  Trees are grown greedily, so that the one of a
    smaller depth is the deepest one cut back: that one alone is fitted on the larger part, and one
    pass over each part scores all depths.  ``parallelism`` is of no use any more, as there is one fit.
    """
    keys = split_keys or (features, label)
    held = train.select(*dict.fromkeys([*keys, features, label])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit_part, valid_part = split_by_key(held, *keys, seed=seed)
        deepest = _tree(max(depths), label, features, seed).fit(fit_part)
        valid_rmse = prefix_errors(deepest, fit_part, valid_part, depths, label)
        if None in valid_rmse.values():
            raise ValueError("the validation part is empty")
        # min keeps the first of equal values.
        depth = min(depths, key=valid_rmse.__getitem__)
        return Tuning(depth, valid_rmse, _tree(depth, label, features, seed).fit(held))
    finally:
        held.unpersist()
