"""Numeric feature transforms."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions import log_abs, present


def log_abs_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """``ln(|x| + 1)`` of each column under the name ``log_<column>``, in the column's place."""
    return df.select(*[
        log_abs(F.col(c)).alias(f"log_{c}") if c in cols else F.col(c) for c in df.columns
    ])


class LogAbs(Transformer):
    """``log_abs_columns`` as a stage."""

    def __init__(self, cols: list[str]):
        super().__init__()
        self.cols = list(cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        return log_abs_columns(df, self.cols)


def log1p_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in cols})


class ZScoreLog(Estimator):
    """Add ``<c>_z`` (sample z-score) and ``<c>_z_log`` = ``ln(|z| + 1)`` for each column.

    With ``drop_source`` only ``<c>_z_log`` stays. A constant column gets NULL, and so does a missing value.
    """

    def __init__(self, cols: list[str], drop_source: bool = True):
        super().__init__()
        self.cols = list(cols)
        self.drop_source = drop_source

    def _fit(self, df: DataFrame) -> ZScoreLogModel:
        x = {c: present(c, df.schema[c].dataType) for c in self.cols}
        row = df.agg(*[
            a for c in self.cols
            for a in (F.avg(x[c]).alias(f"m:{c}"), F.stddev_samp(x[c]).alias(f"s:{c}"))
        ]).first()
        return ZScoreLogModel({c: (row[f"m:{c}"], row[f"s:{c}"]) for c in self.cols}, self.drop_source)


class ZScoreLogModel(Model):
    def __init__(self, stats: dict[str, tuple[float, float]], drop_source: bool):
        super().__init__()
        self.stats = stats
        self.drop_source = drop_source

    def _transform(self, df: DataFrame) -> DataFrame:
        z = {
            c: F.try_divide(present(c, df.schema[c].dataType) - F.lit(mean).cast("double"), F.lit(sd).cast("double"))
            for c, (mean, sd) in self.stats.items()
        }
        df = df.withColumns({f"{c}_z": z[c] for c in z} | {f"{c}_z_log": log_abs(z[c]) for c in z})
        return df.drop(*z, *[f"{c}_z" for c in z]) if self.drop_source else df


def feature_matrix(
    df: DataFrame, label: str, exclude: list[str] | None = None,
    handle_invalid: str = "error", output: str = "features",
) -> DataFrame:
    """All columns but the label and the excluded ones as one vector column.

    ``handle_invalid``: "error" fails on a missing value, "skip" drops its row, "keep" keeps NaN.
    """
    skip = {label, *(exclude or [])}
    inputs = [c for c in df.columns if c not in skip]
    return VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid=handle_invalid).transform(df)
