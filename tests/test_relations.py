"""Components from counts, trees from relations, vectors from counts, sketches."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from storelens.operators import category_pca, cooccurrence, level_trees, sketches, trees
from storelens.operators.quantiles import exact_quantiles

COUNTS = {"distinct": [30, 17, 9, 4, 2, 1], "ties": [12, 5, 5, 5, 2, 2, 1, 1, 1, 1], "all equal": [3, 3, 3, 3], "one": [4], "close": [1001, 1000, 999, 1]}


@pytest.mark.parametrize("name", COUNTS)
def test_components_of_counts(spark, name):
    counts = COUNTS[name]
    k = min(4, len(counts))
    rows = [(f"c{i:02d}",) for i, n in enumerate(counts) for _ in range(n)]
    df = spark.createDataFrame(rows, "category string").repartition(3)
    fitted = category_pca.fit_components(df, "category", k)
    table = {row["category"]: row["loadings"] for row in fitted.loadings().collect()}
    loadings = np.array([table[f"c{i:02d}"] for i in range(len(counts))])
    one_hot = np.repeat(np.eye(len(counts)), counts, axis=0)
    covariance = np.cov(one_hot.T).reshape(len(counts), len(counts))
    wanted = np.sort(np.linalg.eigvalsh(covariance))[::-1][:k]
    assert np.allclose(fitted.eigenvalues(), wanted, atol=1e-12)
    assert np.allclose(loadings.T @ loadings, np.eye(k), atol=1e-9)
    assert np.allclose(covariance @ loadings, loadings * np.array(fitted.eigenvalues()), atol=1e-9)
    assert np.allclose(fitted.means(), one_hot.mean(axis=0) @ loadings, atol=1e-9)
    projected = fitted.transform(df, "p").collect()
    assert len(projected) == sum(counts) and all(np.allclose(row["p"], table[row["category"]]) for row in projected)


def test_components_agree_with_the_dense_ones(spark):
    rows = [(f"c{i}",) for i, n in enumerate([40, 21, 13, 8, 5, 3]) for _ in range(n)]
    df = spark.createDataFrame(rows, "category string")
    indexed = StringIndexer(inputCol="category", outputCol="i").fit(df).transform(df)
    encoded = OneHotEncoder(inputCol="i", outputCol="v", dropLast=False).fit(indexed).transform(indexed)
    dense = PCA(k=4, inputCol="v", outputCol="p").fit(encoded).pc.toArray()
    table = {row["category"]: row["loadings"] for row in category_pca.fit_components(df, "category", 4).loadings().collect()}
    assert np.allclose(np.abs(dense), np.abs([table[f"c{i}"] for i in range(6)]), atol=1e-9)


def test_empty_and_null_categories(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "category string")
    with pytest.raises(ValueError, match="null"):
        category_pca.category_means(df, "category", k=2)
    kept = category_pca.category_means(df, "category", k=2, invalid="keep").first()
    assert kept["meanVector_categoryOneHot"] == pytest.approx([1 / 3, 2 / 3]) and kept["count_total"] == 3
    none = category_pca.category_means(df.limit(0), "category", k=2).first()
    assert (none["count_total"], none["meanVector_categoryPCA"]) == (0, [])


# Trees


def greedy(rows, cuts, depth, node=1):
    """Splits and predictions of a plain greedy tree on (bins, label)."""
    mean = sum(y for _, y in rows) / len(rows)
    found, best = {node: (None, mean)}, None
    for f, own in enumerate(cuts):
        for b in range(len(own)):
            left, right = [y for x, y in rows if x[f] <= b], [y for x, y in rows if x[f] > b]
            if left and right:
                gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - sum(y for _, y in rows) ** 2 / len(rows)
                if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                    best = (gain, f, b)
    if depth and best:
        found[node] = (best[1:], mean)
        found |= greedy([r for r in rows if r[0][best[1]] <= best[2]], cuts, depth - 1, 2 * node)
        found |= greedy([r for r in rows if r[0][best[1]] > best[2]], cuts, depth - 1, 2 * node + 1)
    return found


def test_level_tree_equals_plain_greedy_tree(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 9) * 1.0, rng.choice([0.5, 1.5, None]), (k % 7) * 1.0) for k in range(400)]
    rows = [(a, b, c, a * 3 + (b or 5) * c + rng.random()) for a, b, c in rows]
    df = spark.createDataFrame([*rows, (1.0, 1.0, 1.0, None)], "a double, b double, c double, y double").repartition(3)
    tree = level_trees.fit_level_tree(df, "y", ["a", "b", "c"], depth=3)
    centre = sum(r[3] for r in rows) / len(rows)
    binned = [(tuple(len(cuts) if v is None else sum(c < v for c in cuts) for v, cuts in zip(r[:3], tree.cuts, strict=True)), r[3] - centre) for r in rows]
    plain = greedy(binned, tree.cuts, 3)
    assert tree.splits == {i: s for i, (s, _) in plain.items() if s}
    assert all(tree.predictions[i] == pytest.approx(centre + mean) for i, (_, mean) in plain.items())
    errors = level_trees.depth_errors(tree, df, "y", (0, 1, 2, 3)).first()
    for depth in (0, 1, 2, 3):
        cut_back = greedy(binned, tree.cuts, depth)

        def predicted(x, tree=cut_back):
            node = 1
            while tree[node][0]:
                f, b = tree[node][0]
                node = 2 * node + (x[f] > b)
            return tree[node][1]

        wanted = math.sqrt(sum((y - predicted(x)) ** 2 for x, y in binned) / len(binned))
        assert errors[f"rmse_depth_{depth}"] == pytest.approx(wanted)


def test_constant_labels_have_no_split(spark):
    df = spark.range(50).selectExpr("cast(id as double) as a", "2.0d as y")
    tree = level_trees.fit_level_tree(df, "y", ["a"], depth=3)
    assert tree.splits == {} and tree.predictions == {1: 2.0}
    with pytest.raises(ValueError):
        level_trees.fit_level_tree(df.limit(0), "y", ["a"], depth=1)


def test_cut_back_errors_equal_separate_fits(spark):
    noise = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(1000)) / 10
    df = spark.range(0, 6000, numPartitions=3).select("id", (F.col("id") % 61).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("z"),
                                                      (1e6 + (F.col("id") % 61) * (F.col("id") % 7) + noise).alias("overall"))
    planted = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df).persist()
    train, valid = trees.split_by_key(planted, "id")
    deepest = trees.fit_tree(train, depth=7)
    errors = trees.prefix_errors(deepest, train, valid, (1, 2, 4, 7))
    for depth in (1, 2, 4, 7):
        separate = trees.tree_rmse(train, valid, depth=depth).first()["test_rmse"]
        assert errors[depth] == pytest.approx(separate, rel=1e-6), depth
    assert trees.prefix_errors(deepest, train, valid.limit(0), (1,)) == {1: None}
    planted.unpersist()


# Vectors from counts


def word_rows(spark, partitions):
    rng = random.Random(5)
    groups = [["tea", "cup", "pot", "leaf"], ["car", "wheel", "road", "fuel"], ["dog", "cat", "paw", "fur"]]
    docs = [([*rng.choices(rng.choice(groups), k=rng.randint(1, 6)), *rng.choices(["the", "a"], k=1)],) for _ in range(400)]
    return docs, spark.createDataFrame([*docs, ([],), (None,)], "words array<string>").repartition(partitions)


def test_pairs_and_information(spark):
    docs, df = word_rows(spark, 3)
    plain = Counter()
    for (words,) in docs:
        for i in range(len(words)):
            for j in range(i + 1, min(i + 3, len(words))):
                plain[(words[i], words[j])] += 1
                plain[(words[j], words[i])] += 1
    pairs = cooccurrence.word_pairs(df, "words", 2)
    assert {(r["a"], r["b"]): r["n"] for r in pairs.collect()} == plain
    total, sums = sum(plain.values()), defaultdict(int)
    for (a, _), n in plain.items():
        sums[a] += n
    wanted = {(a, b): math.log(n * total / sums[a] / sums[b]) - math.log(1.2) for (a, b), n in plain.items()}
    found = {(r["a"], r["b"]): r["information"] for r in cooccurrence.shifted_information(pairs, shift=1.2).collect()}
    assert found == pytest.approx({k: v for k, v in wanted.items() if v > 0})


def test_vectors_repeat_after_repartitioning_and_find_the_groups(spark):
    found = []
    for partitions in (2, 7):
        _, df = word_rows(spark, partitions)
        information = cooccurrence.shifted_information(cooccurrence.word_pairs(df, "words", 3))
        vectors = cooccurrence.factor_vectors(information, dimensions=4, more=10)
        found.append({row["word"]: tuple(row["vector"]) for row in vectors.collect()})
        dense_words = sorted(found[0])
        at = {w: i for i, w in enumerate(dense_words)}
        matrix = np.zeros((len(at), len(at)))
        for r in information.collect():
            matrix[at[r["a"]], at[r["b"]]] = r["information"]
    assert found[0] == found[1]
    eigen, turn = np.linalg.eigh(matrix)
    best = np.argsort(-eigen)[:4]
    wanted = (turn[:, best] * eigen[best]) @ turn[:, best].T
    got = np.array([found[0][w] for w in dense_words])
    assert np.allclose(got @ got.T, wanted, atol=1e-2)
    unit = got / np.linalg.norm(got, axis=1, keepdims=True)
    nearest = np.argsort(-(unit @ unit[at["tea"]]))[:4]
    assert {dense_words[i] for i in nearest} == {"tea", "cup", "pot", "leaf"}


# Sketches


def test_audited_quantiles_keep_the_bound(spark):
    df = spark.range(0, 20_000, numPartitions=4).selectExpr("cast(pow(id % 997, 3) as double) as x", "id % 3 as g")
    for bound in (0.05, 0.002, 0.0):
        rows = sketches.audited_quantiles(df, "x", [0.01, 0.5, 0.9], bound, sizes=(32, 400)).collect()
        assert len(rows) == 3 and all(row["rank_error"] <= bound and row["n"] == 20_000 for row in rows)
        assert all(row["below"] == df.where(F.col("x") < row["value"]).count() for row in rows)
    assert sketches.audited_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_sketches_are_stored_and_merged(spark, tmp_path):
    df = spark.range(0, 9000, numPartitions=3).selectExpr("cast(id as double) as x", "id % 3 as g", "id % 10 as day")
    sketches.quantile_sketches(df.union(spark.sql("select double('nan'), 0L, 0L union all select null, 0L, 0L")), "x", "g", "day").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 30
    for row in sketches.sketch_quantiles(sketches.merged_sketches(stored, "g"), [0.25, 0.5]).collect():
        exact = exact_quantiles(df.where(F.col("g") == row["g"]), "x", [0.25, 0.5])
        assert row["n"] == 3000 and row["quantiles"] == pytest.approx(exact, abs=300)
