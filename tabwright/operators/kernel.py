"""Features that turn a linear classifier into a kernel machine."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class NystroemFeatures(Estimator):
    """Features whose inner products are the RBF kernel, exactly between landmarks and nearly elsewhere.

    Landmarks are up to ``landmarks`` different rows, those with the smallest hashes, so they do not depend on the file
    layout. One eigenproblem of their kernel matrix, on the driver, gives the map; directions of no weight are left out.
    With at least as many landmarks as different rows, a linear machine on these features is the kernel machine itself.
    """

    def __init__(self, landmarks: int = 100, input: str = "features", output: str = "kernel_features"):
        super().__init__()
        self.landmarks, self.input, self.output = landmarks, input, output

    def _fit(self, df: DataFrame) -> NystroemModel:
        gamma = kernel_width(df, self.input)
        row = vector_to_array(self.input)
        chosen = df.select(row.alias("x")).where(~F.exists("x", lambda v: F.isnan(v))).groupBy("x").agg(F.xxhash64("x").alias("h")) \
            .orderBy("h", "x").limit(self.landmarks).collect()
        if not chosen:
            raise ValueError("no rows to take landmarks from")
        points = np.array([r["x"] for r in chosen], np.float64)
        values, directions = np.linalg.eigh(rbf(points, points, gamma))
        kept = values > values.max() * 1e-10
        return NystroemModel(points, directions[:, kept] / np.sqrt(values[kept]), gamma, self.input, self.output)


class NystroemModel(Model):
    def __init__(self, points: np.ndarray, weights: np.ndarray, gamma: float, input: str, output: str):
        super().__init__()
        self.points, self.weights, self.gamma, self.input, self.output = points, weights, gamma, input, output

    def _transform(self, df: DataFrame) -> DataFrame:
        points, weights, gamma = self.points, self.weights, self.gamma

        @F.arrow_udf("array<double>")
        def mapped(rows: pa.Array) -> pa.Array:
            if rows.null_count:
                raise ValueError("a row without features")
            x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), points.shape[1])
            out = rbf(x, points, gamma) @ weights
            ends = np.arange(len(rows) + 1, dtype=np.int32) * weights.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out.ravel(), pa.float64()))

        return df.withColumn(self.output, array_to_vector(mapped(vector_to_array(self.input))))


def rbf(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    apart = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(apart, 0))


def kernel_width(df: DataFrame, input: str) -> float:
    """1 / (features * variance of all their values)."""
    s = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(input)).alias("s")).first()["s"]
    mean, var, n = s["mean"].toArray(), s["variance"].toArray(), s["count"]
    spread = float(np.mean(var * (n - 1) / max(n, 1) + (mean - mean.mean()) ** 2)) if len(mean) else 0.0
    return 1.0 / (len(mean) * spread) if spread > 0 else 1.0
