"""One-against-rest and kernel machines against numpy, and predictions of held-out rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.operators import kernel


def blobs(n=600, labels=4, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, 3)) * 3
    y = rng.integers(0, labels, n)
    return centres[y] + rng.normal(size=(n, 3)), y


def frame(spark, x, y, kind="int"):
    df = spark.createDataFrame([(i, *map(float, r), v) for i, (r, v) in enumerate(zip(x, y))], f"id int, a double, b double, c double, y {kind}")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def logistic_by_newton(x, y, c):
    """Weights and intercept that minimise summed log loss + |w|**2 / 2c."""
    a = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(a.shape[1]), np.diag([1 / c] * x.shape[1] + [0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-a @ w))
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-12 * np.eye(len(w)), a.T @ (p - y) + penalty @ w)
    return w


@pytest.mark.parametrize("labels", [2, 4])
def test_one_against_rest_equals_newton(spark, labels):
    x, y = blobs(labels=labels)
    names = np.array(["d", "b", "c", "a"])[y]
    df = frame(spark, x, [str(v) for v in names], "string").withColumn("y", F.when(F.col("id") >= 10, F.col("y")))
    model = op.OneAgainstRest("y").fit(df)
    assert model.labels == sorted(set(names)) and len(model.fits) == (labels if labels > 2 else 1)
    own = model.labels if labels > 2 else model.labels[1:]
    scores = np.c_[[1 / (1 + np.exp(-np.c_[x, np.ones(len(x))] @ logistic_by_newton(x[10:], (names[10:] == v).astype(float), 1.0))) for v in own]].T
    scores = scores if labels > 2 else np.c_[1 - scores, scores]
    rows = {r.id: r for r in model.transform(df).collect()}
    for i, s in enumerate(scores):
        assert np.allclose(rows[i].probability, s / s.sum(), atol=1e-3)
        if np.sort(s)[-1] - np.sort(s)[-2] > 0.01:
            assert rows[i].prediction == model.labels[int(s.argmax())]


def test_odd_labels(spark):
    x, y = blobs(20)
    df = frame(spark, x, [7] * 20)
    assert {r.prediction for r in op.OneAgainstRest("y").fit(df).transform(df).collect()} == {7}
    with pytest.raises(ValueError):
        op.OneAgainstRest("y").fit(df.withColumn("y", F.lit(None).cast("int")))
    zero = df.withColumn("y", (F.col("id") % 3).cast("int"))
    model = op.OneAgainstRestModel([3, 5, 9], [(np.zeros(3), 0.0)] * 3, "features")
    assert {r.prediction for r in model.transform(zero).collect()} == {3}  # a tie


def kernel_machine(k, y, c, rounds=4000):
    """Dual coordinate ascent for the hinge loss with the kernel matrix ``k`` (a constant entry stands for the intercept)."""
    a, k = np.zeros(len(y)), k + 1.0
    rng = np.random.default_rng(0)
    for _ in range(rounds):
        for i in rng.permutation(len(y))[:50]:
            a[i] = np.clip(a[i] + (1 - y[i] * (k[i] @ (a * y))) / k[i, i], 0, c)
    return k @ (a * y)


def test_landmarks_agree_with_the_kernel_machine(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] ** 2 + x[:, 1] ** 2 < 1.4).astype(int)
    df = frame(spark, x, y.tolist()).withColumn("y", F.col("y").cast("double"))
    gamma = kernel.kernel_width(df, "features")
    exact = kernel_machine(kernel.rbf(x, x, gamma), 2 * y - 1, 10.0) > 0
    got = {r.id: r.prediction for r in op.predict(op.svm("y", 300, 10.0, landmarks=100).fit(df), df, ["id"]).collect()}
    agreement = np.mean([got[i] == e for i, e in enumerate(exact)])
    assert agreement >= 0.97


def test_all_rows_as_landmarks_give_the_kernel(spark):
    x, y = blobs(60)
    df = frame(spark, np.r_[x, x], [*y.tolist()] * 2)
    model = op.NystroemFeatures(200).fit(df)
    assert len(model.points) == 60
    mapped = np.array([r.k for r in model.transform(df).orderBy("id").select(vector_to_array("kernel_features").alias("k")).collect()])
    assert np.allclose(mapped @ mapped.T, kernel.rbf(np.r_[x, x], np.r_[x, x], model.gamma), atol=1e-6)
    again = op.NystroemFeatures(10).fit(df.repartition(7))
    assert np.allclose(again.points, op.NystroemFeatures(10).fit(df).points)


def test_held_out_rows_are_the_exact_fifth(spark):
    x, y = blobs(50, 2)
    df = frame(spark, x, y.tolist()).drop("features")
    out = op.held_out_predictions(df, lambda n: op.OneAgainstRest("y"), "y", ["id"])
    assert out.columns == ["id", "prediction"] and out.count() == 10


def test_recipes_of_a_branch_share_one_copy(spark, monkeypatch):
    x, y = blobs(200, 2)
    df = frame(spark, x, y.tolist()).drop("features").withColumnRenamed("y", "label")
    from tabwright.operators import train
    written = []
    store = train.materialise
    monkeypatch.setattr(train, "materialise", lambda *a, **o: written.append(store(*a, **o)) or written[-1])
    rows = op.prepare(df, op.RECIPES["Logistic_sklearn"], "label", ["id"])
    assert rows.held.count() == 40 and rows.train.count() == 160 and sorted(rows.sizes) == [-1, 0, 1, 2, 3, 4]
    first = op.evaluate_prepared(rows, op.RECIPES["Logistic_sklearn"])[1]
    second = op.evaluate_prepared(rows, op.RECIPES["SVM_sklearn"])[1]
    assert len(written) == 1
    rows.drop()
    assert {r.model for r in first.collect()} == {"Logistic_sklearn"} and second.count() == 4  # the scores outlive the copy
    with pytest.raises(Exception):
        rows.train.count()
    alone = op.train_and_evaluate(df, op.RECIPES["Logistic_sklearn"], "label", ["id"])[1]
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, first.collect()))


def test_fits_that_keep_much_run_alone_on_smaller_parts(spark, monkeypatch):
    import threading
    from tabwright.operators import train
    x, y = blobs(300, 2)
    df = frame(spark, x, y.tolist()).select("id", F.col("y").cast("double").alias("y"), "features", (F.col("id") % 3).cast("int").alias("fold")).coalesce(1)
    lock, running, most, parts = threading.Lock(), [], [], []

    class Watched(train.LogisticRegression):
        def fit(self, rows, params=None):
            with lock:
                running.append(1)
                most.append(len(running))
                parts.append(rows.rdd.getNumPartitions())
            try:
                return super().fit(rows, params)
            finally:
                with lock:
                    running.pop()

    def validated(kept):
        most.clear(), parts.clear()
        evaluator = train.MulticlassClassificationEvaluator(labelCol="y", metricName="accuracy")
        return train.cross_validate(df, Watched(labelCol="y"), evaluator, None, [0, 1, 2], kept=kept)[1]

    small = validated(1000)
    assert set(parts) == {1}
    monkeypatch.setattr(train, "SIDE_BY_SIDE", 999)
    monkeypatch.setattr(train, "BLOCK", 250)
    assert abs(validated(1000) - small) < 1e-6 and max(most) == 1 and set(parts) == {4}
