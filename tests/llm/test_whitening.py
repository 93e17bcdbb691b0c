"""Whitening against numpy on all rows, odd rows and tables, and the solver on hard matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import bidiagonal, whitening
from tabwright.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, x string"


def hard_matrices():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    p = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    return {
        "even": rng.normal(size=(300, 40)), "falling": rng.normal(size=(300, 40)) * 10.0 ** -np.arange(40),
        "rising": rng.normal(size=(300, 40)) * 10.0 ** np.arange(-20, 20), "identity": np.eye(40), "rotation": q,
        "clusters": q @ np.diag(np.r_[np.full(15, 5.0), np.ones(25)]) @ p, "thin": rng.normal(size=(300, 4)) @ rng.normal(size=(4, 40)),
        "few": rng.normal(size=(7, 40)), "equal rows": np.ones((9, 4)), "one": rng.normal(size=(9, 1)), "zero": np.zeros((4, 4)),
        "blocks": np.kron(np.eye(5), rng.normal(size=(20, 8))), "twice": rng.integers(-3, 4, (200, 6)).astype(float)[:, [0, 1, 2, 3, 4, 5] * 3],
        "wilkinson": np.diag(np.sqrt(np.abs(np.arange(-10, 11)) + 1.0)) + np.diag(np.ones(20), 1),
        "some zeros": np.diag([3.0, 3.0, 3.0, 0.0, 0.0]),
    }


@pytest.mark.parametrize("name", sorted(hard_matrices()))
def test_singular_values_and_directions(name):
    a = hard_matrices()[name]
    values, directions = bidiagonal.spectrum(np.linalg.qr(a, mode="r"), 40)
    wanted = np.linalg.svd(a, compute_uv=False)
    rank = int((wanted > 1e-11 * max(wanted[0], 1e-300)).sum())
    assert abs(len(values) - rank) <= (3 if name in ("falling", "rising") else 0)
    if not rank:
        return
    assert np.abs(values - wanted[:len(values)]).max() <= 1e-13 * wanted[0]
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-9
    white = a @ directions / values
    assert np.abs(white.T @ white - np.eye(len(values))).max() < 1e-8


def test_small_singular_values_keep_their_digits():
    values = bidiagonal.dqds(10.0 ** -np.arange(0.0, 60.0, 6.0), 10.0 ** -np.arange(1.0, 55.0, 6.0))
    product = math.prod(values)  # the determinant of a bidiagonal matrix is that of its diagonal
    assert abs(product / math.prod(10.0 ** -np.arange(0.0, 60.0, 6.0)) - 1) < 1e-13


def brute(vectors: dict[int, np.ndarray]):
    x = {i: np.floor(64 * v.astype(np.float64)).astype(np.int64) + 1000000 for i, v in vectors.items()}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    c = (fit - sums / n).astype(float)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return n, sums, e, {i: (r - sums / n) @ v / np.sqrt(e) for i, r in x.items()}, {
        i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for i, r in x.items()}


def test_query_equals_numpy(spark, small):
    n, _, e, white, apart = brute({r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()})
    rows = QUERIES["op11_qd_whitening"](spark, small).collect()
    assert len(rows) == 16 * len(white)
    signs = {}
    for r in rows:
        k = r.component - 1
        want = white[r.vec_id][k]
        if abs(want) > 0.1:
            signs.setdefault(k, np.sign(want * r.whitened))
        assert (r.n, r.deviation) == (n, apart[r.vec_id])
        assert abs(r.whitened - signs.get(k, 1) * want) < 1e-7 or abs(want) <= 0.1 and abs(abs(r.whitened) - abs(want)) < 1e-7
        assert abs(r.explained / (e[k] / e.sum()) - 1) < 1e-9 and r.identity_error < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], "a"), (1, [0.5, 1.0], "b"), (2, [-0.5, 0.25], "c"), (None, [0.0, -1.0], None), (3, None, "d"), (4, [nan, 1.0], "d"),
            (5, [1.0, inf], "d"), (6, [None, 1.0], "d"), (7, [], "d"), (8, [1.0, 2.0, 3.0], "d"), (9, [1e30, -1e30], "e")]
    df, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA).withColumn("whitened", F.lit(0)))
    got = {(r.vec_id, r.x): r.whitened_ for r in df.collect()}
    assert df.columns == ["vec_id", "embedding", "x", "whitened", "whitened_"] and model.n == 4 and model.width == 2
    assert set(got) == {(1, "a"), (1, "b"), (2, "c"), (None, None), (9, "e")}
    assert got[1, "a"] == got[1, "b"] and got[9, "e"].deviation is None
    assert all(len(w["values"]) == len(model.values) >= 1 for w in got.values())


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "b")], [(1, [], "a")]])
def test_tables_without_variance(spark, rows):
    df, model = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert [len(r.whitened["values"]) for r in df.collect()] == ([0, 0] if len(rows) == 2 else [])
    assert model is None or len(model.values) == 0


def test_large_sums_and_hot_rows(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(50, 3)) * [1, 1e3, 1e6]
    rows = [(i, [float(v) for v in points[i % 50 if i % 3 else 0]]) for i in range(600)]
    vectors = {i: np.array(v) for i, v in rows}
    n, _, e, white, apart = brute(vectors)
    df, model = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7))
    assert model.n == n and np.allclose(model.values, e, rtol=1e-9) and model.error < 1e-9
    for r in df.collect():
        want = apart[r.vec_id] if apart[r.vec_id] < 1 << 63 else None
        assert r.whitened.deviation == want and np.allclose(np.abs(r.whitened["values"]), np.abs(white[r.vec_id]), atol=1e-6)
