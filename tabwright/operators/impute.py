"""Filling missing values from statistics of the frame."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import present
from tabwright.operators.profile import column_modes


class Impute(Estimator):
    """Fill missing values with the column's mean, mode or median.

    ``strategies``    column -> "mean", "mode" (smallest value on a tie) or "median" (approximate).
    ``prefix``        write to ``<prefix><column>`` beside the column instead of in place.
    ``fill_under``    fill only columns whose missing share is above 0 and below this.
    ``drop_over``     drop columns whose missing share is above this.

    Fitting takes one aggregation for all shares, means and medians, and one more for the modes of
    those columns that do need one.
    """

    def __init__(
        self, strategies: dict[str, str], prefix: str = "",
        fill_under: float | None = None, drop_over: float | None = None,
    ):
        super().__init__()
        unknown = set(strategies.values()) - {"mean", "mode", "median"}
        if unknown:
            raise ValueError(f"unknown strategies: {sorted(unknown)}")
        self.strategies = dict(strategies)
        self.prefix = prefix
        self.fill_under = fill_under
        self.drop_over = drop_over

    def _fit(self, df: DataFrame) -> ImputeModel:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for c, strategy in self.strategies.items():
            x = present(c, df.schema[c].dataType)
            aggs.append(F.count(x).alias(f"n:{c}"))
            if strategy == "mean":
                aggs.append(F.avg(x).alias(f"v:{c}"))
            elif strategy == "median":
                aggs.append(F.percentile_approx(x.cast("double"), 0.5, 10_000).alias(f"v:{c}"))
        stats = df.agg(*aggs).first()
        rows = stats["rows"]
        share = {c: (rows - stats[f"n:{c}"]) / rows if rows else 0.0 for c in self.strategies}

        dropped = [c for c in share if self.drop_over is not None and share[c] > self.drop_over]
        chosen = [
            c for c in share
            if c not in dropped and (self.fill_under is None or 0 < share[c] < self.fill_under)
        ]
        fills = {c: stats[f"v:{c}"] for c in chosen if self.strategies[c] != "mode"}
        by_mode = [c for c in chosen if self.strategies[c] == "mode"]
        if by_mode:
            fills.update(column_modes(df, by_mode))
        return ImputeModel({c: fills[c] for c in chosen}, self.strategies, dropped, self.prefix)


class ImputeModel(Model):
    def __init__(self, fills: dict[str, object], kinds: dict[str, str], dropped: list[str], prefix: str):
        super().__init__()
        self.fills = fills
        self.kinds = kinds
        self.dropped = dropped
        self.prefix = prefix

    def _transform(self, df: DataFrame) -> DataFrame:
        def filled(c: str):
            dtype, fill = df.schema[c].dataType, self.fills[c]
            if fill is None:
                return present(c, dtype)
            return F.coalesce(present(c, dtype), F.lit(fill).cast(dtype) if self.kinds[c] == "mode" else F.lit(fill))
        return df.withColumns({self.prefix + c: filled(c) for c in self.fills}).drop(*self.dropped)
