"""Projection, filtering and repair of dirty columns."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import outside, present, to_double
from tabwright.operators.profile import missing_profile


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_at(df: DataFrame, positions: list[int], names: list[str] | None = None) -> DataFrame:
    """Columns by 0-based position, optionally renamed."""
    names = names or [df.columns[i] for i in positions]
    if len(names) != len(positions):
        raise ValueError("one name per position is needed")
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(n) for i, n in zip(positions, names)])


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def require(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which every given column is present (not NULL, NaN or blank)."""
    for c in cols:
        df = df.filter(present(c, df.schema[c].dataType).isNotNull())
    return df


def cast_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns as doubles in one projection; whatever is not a number becomes NULL."""
    chosen = set(cols or df.columns)
    return df.select(*[
        to_double(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns
    ])


def invalidate(df: DataFrame, rules: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Set values below the first or above the second bound of their column's rule to NULL."""
    return df.withColumns({
        c: F.when(~outside(F.col(f"`{c}`"), below, above), F.col(f"`{c}`")) for c, (below, above) in rules.items()
    })


def add_null(df: DataFrame, name: str, dtype: str = "int") -> DataFrame:
    return df.withColumn(name, F.lit(None).cast(dtype))


class DropSparse(Estimator):
    """Drop columns of which more than ``max_missing`` is missing."""

    def __init__(self, max_missing: float = 0.1, cols: list[str] | None = None):
        super().__init__()
        self.max_missing = max_missing
        self.cols = cols

    def _fit(self, df: DataFrame) -> DropModel:
        profile = missing_profile(df, self.cols).collect()
        return DropModel([r["col_name"] for r in profile if (r["pct_missing"] or 0.0) > self.max_missing])


class DropModel(Model):
    def __init__(self, dropped: list[str]):
        super().__init__()
        self.dropped = dropped

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.dropped)
