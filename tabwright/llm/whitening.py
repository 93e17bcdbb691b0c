"""Whitening of embeddings: uncorrelated components of unit variance, from a blockwise QR of centred rows.

1. Entries become whole numbers, so sums and means are exact. Each different vector is kept once (the fit list),
   in shared storage. Equal vectors are joined before the shuffle, so a vector that a third of all rows hold
   is one row of each task.
2. Every task centres its rows of the list and reduces them, block by block, to a triangle R; triangles are stacked
   and reduced again in rounds. R'R is the sum of the products of all centred rows, without ever forming it.
3. ``bidiagonal.spectrum`` takes R, as wide as a vector, to singular values s and directions v. The
   eigenvalues of the covariance are s * s / n.
4. A row is centred, projected on each v and divided by s / sqrt(n).

What reaches the driver: sums of each dimension, one triangle, and the products of the whitened components.

Defined results: rows whose vector is null, or holds null, NaN or infinity, take no part, like rows whose vector
has another length than most rows have (of equally common lengths the greatest counts). Whole numbers beyond 2**52
are taken as 2**52. Repeated rows count once in the fit and are all returned. Components with a variance of (numerically) zero
are left out, so one single vector gives no components, and an empty table no rows. Equal eigenvalues give
any orthonormal directions of their space, the same for all rows. A deviation beyond 64 bits is null. Rows without an id are
transformed like all others; other columns are kept, and new names get underscores where they clash.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm import bidiagonal, vectors
from tabwright.llm.tokens import free_name
from tabwright.sources.durable import drop_copy, materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 21  # numbers in a block of rows that is reduced at a time
ROUNDS = (64, 8, 1)  # tasks in which triangles are reduced
EXACT = 1 << 62  # sums below it are exact in 64 bits


@dataclass(frozen=True)
class Whitening:
    """``n`` different vectors, their ``sums`` by dimension, and components by falling ``values`` (eigenvalues)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray  # (width, components)
    total: float  # trace of the covariance
    error: float = 0.0  # largest entry of the whitened covariance minus the identity

    @property
    def width(self) -> int:
        return len(self.sums)

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.total for v in self.values]

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self._mean()
        return (x - whole).astype(np.float64) - rest / self.n

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        pairs = [divmod(s, self.n) for s in self.sums]
        return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.directions / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S) ** 2 of each row, exact; None beyond 64 bits."""
        whole, rest = self._mean()
        apart = x - whole
        most = (int(np.abs(apart).max(initial=0)) + 1) * self.n
        if most * most * max(self.width, 1) < EXACT:
            apart = apart * self.n - rest
            return (apart * apart).sum(axis=1).tolist()
        exact = apart.astype(object) * self.n - rest.astype(object)
        return [t if t < 1 << 63 else None for t in (exact * exact).sum(axis=1).tolist()]


def whole_rows(df: DataFrame, vector: str = "embedding", times: int = 64, plus: int = 1_000_000,
               into: str = "x") -> DataFrame:
    """Rows with a whole vector, and ``into``: its entries c as floor(times * c) + plus."""
    source = F.col(f"`{vector}`")
    return df.where(vectors.is_whole(source)).withColumn(into, vectors.floored(source, times, plus))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    rows = max(BLOCK // max(width, 1), 2 * width, 1)
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield vectors.matrix(batch.column(0).slice(at, rows), width)


def _sums(fit_list: DataFrame, width: int) -> list[int]:
    def part(batches):
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for x in _blocks(batches, width):
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(high), pa.array(low)], ["k", "high", "low"])

    sums = fit_list.select("x").mapInArrow(part, "k long, high long, low long").groupBy("k").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    return [(int(r["high"]) << 32) + int(r["low"]) for r in sums.orderBy("k").collect()]  # one row per dimension


def _reduced(parts: Iterator[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    r = np.zeros((0, width))
    for part in parts:
        r = np.linalg.qr(np.vstack([r, part]), mode="r")
    if len(r):
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])


def triangle(fit_list: DataFrame, centre: Whitening) -> np.ndarray:
    """R of the centred rows of ``fit_list``."""
    width = centre.width

    def first(batches):
        return _reduced((centre.centred(x) for x in _blocks(batches, width)), width)

    def again(batches):
        return _reduced((np.frombuffer(r, np.float64).reshape(-1, width) for b in batches for r in b.column(0).to_pylist()), width)

    parts = fit_list.select("x").mapInArrow(first, "r binary")
    for tasks in ROUNDS:
        parts = parts.repartition(tasks).mapInArrow(again, "r binary")
    rows = parts.collect()  # one triangle
    return np.frombuffer(rows[0]["r"], np.float64).reshape(-1, width) if rows else np.zeros((0, width))


def _identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Of the covariance of the whitened rows themselves, centred and divided by n."""
    k = len(model.values)
    if not k:
        return 0.0

    def products(batches):
        total = np.zeros((k, k))
        for x in _blocks(batches, model.width):
            w = model.whiten(x)
            total += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], ["i", "j", "total"])

    cells = fit_list.select("x").mapInArrow(products, "i long, j long, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    return cells.agg(F.max(F.abs(F.col("total") / model.n - (F.col("i") == F.col("j")).cast("double"))).alias("e")).first()["e"]


def fit(rows: DataFrame, x: str = "x", components: int = 16) -> Whitening | None:
    """The whitening learnt from the different vectors in the array<long> column ``x``; None without rows."""
    stored = materialise(rows.select(F.col(f"`{x}`").alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("rows")))
    sizes = stored.groupBy(F.size("x").alias("width")).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("rows"), F.desc("width")).head(1)
    if not sizes or not sizes[0]["width"]:
        drop_copy(stored)
        return None
    width, n = sizes[0]["width"], sizes[0]["n"]
    fit_list = stored.where(F.size("x") == width)
    centre = Whitening(n, tuple(_sums(fit_list, width)), np.zeros(0), np.zeros((width, 0)), 0.0)
    r = triangle(fit_list, centre) / np.sqrt(n)
    values, directions = bidiagonal.spectrum(r, components)
    model = Whitening(n, centre.sums, values ** 2, directions, float((r * r).sum()))
    model = Whitening(n, centre.sums, values ** 2, directions, model.total, _identity_error(fit_list, model))
    drop_copy(stored)
    return model


def whitened(x: Column, model: Whitening) -> Column:
    """struct(values array<double>, deviation long) of an array<long> column of the model's width."""
    @F.arrow_udf("values array<double>, deviation long")
    def transform(column: pa.Array) -> pa.Array:
        rows = vectors.matrix(column, model.width)
        return pa.StructArray.from_arrays(
            [vectors.list_column(model.whiten(rows)), pa.array(model.deviations(rows), pa.int64())], ["values", "deviation"])

    return transform.asNondeterministic()(x)


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16, times: int = 64, plus: int = 1_000_000,
           into: str = "whitened") -> tuple[DataFrame, Whitening | None]:
    """(rows with a whole vector and ``into``: struct(values, deviation), the model)."""
    x = free_name(df, "x")
    rows = whole_rows(df, vector, times, plus, x)
    model = fit(rows, x, components)
    into = free_name(df, into)
    if model is None:
        nothing = F.lit(None).cast("struct<values:array<double>,deviation:bigint>")
        return rows.where(F.lit(False)).withColumn(into, nothing).drop(x), None
    return rows.where(F.size(x) == model.width).withColumn(into, whitened(F.col(x), model)).drop(x), model
