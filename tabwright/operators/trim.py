"""Outlier rows."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import present


class SigmaTrim(Estimator):
    """Keep rows within ``k`` sample standard deviations of the mean, column after column.

    The bounds of a column come from the rows that all columns before it left over, so the order
    of ``cols`` matters and fitting takes one aggregation per column. Each reads only the columns
    trimmed so far, with the earlier bounds as literals that are pushed into the scan; the frame
    should therefore come straight from a stored table (see ``materialise``). Bounds are inclusive,
    missing values are trimmed, columns the frame does not have are skipped.
    """

    def __init__(self, cols: list[str], k: float = 2.0):
        super().__init__()
        self.cols = list(cols)
        self.k = k

    def _fit(self, df: DataFrame) -> SigmaTrimModel:
        bounds: dict[str, tuple[float | None, float | None]] = {}
        for c in (c for c in self.cols if c in df.columns):
            left = SigmaTrimModel(bounds).transform(df)
            x = present(c, df.schema[c].dataType)
            s = left.agg(
                F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"),
                F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("n"),
            ).first()
            if s["n"] < 2:
                bounds[c] = (None, None)
            elif s["min"] == s["max"]:  # a rounded mean must not cut a constant column
                bounds[c] = (float(s["min"]), float(s["max"]))
            else:
                bounds[c] = (s["mean"] - self.k * s["sd"], s["mean"] + self.k * s["sd"])
        return SigmaTrimModel(bounds)


class SigmaTrimModel(Model):
    """Without bounds (fewer than two values) no row of that column passes."""

    def __init__(self, bounds: dict[str, tuple[float | None, float | None]]):
        super().__init__()
        self.bounds = dict(bounds)

    def _transform(self, df: DataFrame) -> DataFrame:
        def within(c: str) -> Column:
            lo, hi = (F.lit(b).cast("double") for b in self.bounds[c])
            return (F.col(f"`{c}`") >= lo) & (F.col(f"`{c}`") <= hi)  # NaN is above every bound
        for c in self.bounds:
            df = df.filter(within(c))
        return df
