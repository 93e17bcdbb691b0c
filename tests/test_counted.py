"""Forests grown from counts: against Spark's forest and brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.operators import counted, train

FEATURES = ["a", "b", "c", "d"]


def frame(spark, n=4000, seed=3):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, 2)), rng.integers(0, 5, n), rng.integers(0, 80, n)]
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * x[:, 2] + rng.normal(size=n) * 0.3 > 0.6).astype(float)
    df = spark.createDataFrame([(k, *map(float, r), float(v)) for k, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, d double, label double")
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def share_right(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


def test_as_good_as_spark_s_forest(spark):
    train_rows, held = frame(spark), frame(spark, seed=4)
    mine = counted.CountedForest("label").fit(train_rows)
    theirs = RandomForestClassifier(labelCol="label", numTrees=100, maxDepth=5, seed=0).fit(train_rows)
    assert isinstance(mine, RandomForestClassificationModel) and mine.getNumTrees == 100 and mine.numFeatures == 4 and mine.numClasses == 2
    assert max(t.depth for t in mine.trees) <= 5
    assert abs(share_right(mine, held) - share_right(theirs, held)) < 0.01
    both = mine.transform(held).select("id", vector_to_array("probability").alias("p")).join(
        theirs.transform(held).select("id", vector_to_array("probability").alias("q")), "id").select(F.expr("abs(p[1] - q[1])").alias("d"))
    assert both.agg(F.avg("d")).first()[0] < 0.03
    assert np.abs(mine.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.1


def test_the_same_trees_from_any_layout(spark):
    """As long as the quantiles are exact, which they are here."""
    df = frame(spark, 500)
    found = [counted.CountedForest("label", trees=5).fit(rows).toDebugString.split("\n", 1)[1] for rows in (df, df.repartition(7, "d"))]
    assert found[0] == found[1]


def test_large_tables_are_counted(spark, monkeypatch):
    """Before, a forest of any table visited each row once for every tree and level."""
    assert isinstance(op.forest("label", train.COUNTED), RandomForestClassifier)
    assert isinstance(op.forest("label", train.COUNTED + 1), op.CountedForest)
    monkeypatch.setattr(train, "COUNTED", 0)
    df = frame(spark, 600).select("id", *FEATURES, (F.col("a") > 0).cast("double").alias("target"))
    _, metrics = op.train_and_evaluate(df, op.RECIPES["RF_sklearn"], "target", ["id"])
    assert all(r.value > 0.97 for r in metrics.collect())


def test_every_row_is_counted(spark):
    df = frame(spark, 3000).select("label", vector_to_array("features").alias("x")).repartition(5)
    cuts, labels, n = counted.feature_cuts(df)
    bins, counts = counted.cell_counts(df, cuts, labels)
    assert (labels, n, counts.sum()) == (2, 3000, 3000)
    assert cuts[2].tolist() == [0.5, 1.5, 2.5, 3.5] and all(len(c) == 31 for k, c in enumerate(cuts) if k != 2)
    rows = df.collect()
    want = {}
    for r in rows:
        cell = tuple(sum(v > c for c in cut) for v, cut in zip(r.x, cuts))
        want.setdefault(cell, [0, 0])[int(r.label)] += 1
    assert {tuple(b): c for b, c in zip(bins.tolist(), counts.tolist())} == want


class Whole:
    """A draw that takes every row once, and the first features."""

    def poisson(self, counts):
        return counts

    def random(self, shape):
        return np.tile(np.arange(shape[1]), (shape[0], 1))


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(5)
    bins, counts = rng.integers(0, 4, (60, 3)).astype(np.uint8), rng.integers(0, 9, (60, 2))
    cuts = [np.arange(3.0)] * 3
    nodes = counted.grow(bins, counts, cuts, 3, 3, Whole())

    def gini(w):
        return 1 - ((w / w.sum()) ** 2).sum()

    def check(k, rows):
        stats = counts[rows].sum(axis=0)
        assert nodes[k]["stats"].tolist() == stats.tolist()
        gains = {}
        for f in range(3):
            for c in range(3):
                low = rows[bins[rows, f] <= c]
                high = rows[bins[rows, f] > c]
                n, m = counts[low].sum(axis=0), counts[high].sum(axis=0)
                if n.sum() and m.sum():
                    gains[f, c] = gini(stats) - n.sum() / stats.sum() * gini(n) - m.sum() / stats.sum() * gini(m)
        if "left" not in nodes[k]:
            return 0
        f, c = nodes[k]["feature"], nodes[k]["cut"]
        assert nodes[k]["gain"] == pytest.approx(max(gains.values())) == pytest.approx(gains[f, c])
        return 1 + max(check(nodes[k]["left"], rows[bins[rows, f] <= c]), check(nodes[k]["left"] + 1, rows[bins[rows, f] > c]))

    assert check(0, np.arange(60)) == 3


def test_leaves_with_one_prediction_are_one():
    nodes = [{"stats": np.array([9.0, 5.0]), "feature": 0, "cut": 1, "gain": 0.1, "left": 1}, {"stats": np.array([6.0, 1.0])}, {"stats": np.array([3.0, 4.0]), "feature": 1, "cut": 0, "gain": 0.2, "left": 3},
             {"stats": np.array([1.0, 2.0])}, {"stats": np.array([1.0, 2.0])}]
    rows = counted.listed(nodes, [np.array([1.0, 2.0]), np.array([7.0])])
    assert [(r["id"], r["leftChild"], r["rightChild"], r["prediction"], r["split"]["leftCategoriesOrThreshold"]) for r in rows] == [
        (0, 1, 2, 0.0, [2.0]), (1, -1, -1, 0.0, []), (2, -1, -1, 1.0, [])]


def test_many_cells_are_left_to_spark_s_forest(spark, monkeypatch):
    df = frame(spark, 300)
    monkeypatch.setattr(counted, "CELLS", 1000)
    monkeypatch.setattr(counted, "cell_counts", None)
    model = counted.CountedForest("label", trees=3).fit(df)
    assert model.getNumTrees == 3 and share_right(model, df) > 0.7


@pytest.mark.parametrize("label", ["NULL", "0.5", "-1.0"])
def test_labels_are_whole_numbers(spark, label):
    df = frame(spark, 20).withColumn("label", F.expr(f"IF(id = 3, {label}, label)"))
    with pytest.raises(ValueError):
        counted.CountedForest("label").fit(df)


def test_one_label_and_one_value(spark):
    df = frame(spark, 50).withColumn("label", F.lit(0.0))
    model = counted.CountedForest("label", trees=2).fit(df)
    assert share_right(model, df) == 1
