"""Vectors of whole numbers made from vectors of floating-point ones, and their numpy form."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LARGEST = float(1 << 52)  # entries beyond it are taken as it, so that they stay exact as doubles


def is_whole(vector: Column) -> Column:
    """True if a vector is there and all its entries are finite numbers."""
    def finite(c: Column) -> Column:
        x = c.cast("double")
        return c.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return vector.isNotNull() & F.coalesce(F.forall(vector, finite), F.lit(False))


def floored(vector: Column, times: int, plus: int = 0) -> Column:
    """array<long> of floor(times * entry) + plus."""
    def one(c: Column) -> Column:
        x = F.floor(c.cast("double") * F.lit(float(times)))
        return F.greatest(F.least(x, F.lit(int(LARGEST))), F.lit(-int(LARGEST))).cast("long") + F.lit(plus).cast("long")

    return F.transform(vector, one)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array<long> column without nulls as int64 of (rows, width)."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def list_column(values: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of lists."""
    rows, width = values.shape
    ends = np.arange(0, (rows + 1) * width, width, dtype=np.int32) if width else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).ravel()))
