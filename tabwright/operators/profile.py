"""Column profiles.

Each statistic of all columns comes out of one aggregation; the long form (one row per column) is
made from its single result row, so it costs nothing at scale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import nan_to_null, present


def _one_row_per_column(df: DataFrame, cols: list[str], stats: Callable[[str], dict[str, Column]]) -> DataFrame:
    """Aggregate ``stats(column)`` for every column in one pass and lay the result out long."""
    plan = {c: stats(c) for c in cols}
    wide = df.agg(*[
        agg.alias(f"{i}:{name}") for i, c in enumerate(cols) for name, agg in plan[c].items()
    ])
    rows = F.array(*[
        F.struct(F.lit(c).alias("col_name"), *[F.col(f"{i}:{name}").alias(name) for name in plan[c]])
        for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(rows))


def _missing_count(df: DataFrame, name: str) -> Column:
    return F.count_if(present(name, df.schema[name].dataType).isNull())


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def missing_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(col_name, n_rows, n_missing, pct_missing) per column."""
    cols = list(cols or df.columns)
    counts = _one_row_per_column(df, cols, lambda c: {
        "n_rows": F.count(F.lit(1)), "n_missing": _missing_count(df, c),
    })
    return counts.withColumn("pct_missing", F.try_divide(F.col("n_missing"), F.col("n_rows")))


def numeric_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_name, n, mean, sd) per column, missing values skipped, sample standard deviation."""
    def stats(c: str) -> dict[str, Column]:
        x = present(c, df.schema[c].dataType)
        return {"n": F.count(x), "mean": F.avg(x), "sd": F.stddev_samp(x)}
    return _one_row_per_column(df, list(cols), stats)


def skew_profile(df: DataFrame, cols: list[str], cutoff: float = 0.5) -> DataFrame:
    """(col_name, n, skewness, is_skewed): bias-corrected skewness; NULL below three values."""
    def stats(c: str) -> dict[str, Column]:
        x = present(c, df.schema[c].dataType)
        return {"n": F.count(x), "biased": F.skewness(x)}
    n = F.col("n").cast("double")
    correction = F.when(n >= 3, F.sqrt(n * (n - 1)) / (n - 2))
    return _one_row_per_column(df, list(cols), stats).select(
        "col_name", "n", (F.col("biased") * correction).alias("skewness"),
    ).withColumn("is_skewed", F.coalesce(F.abs("skewness") > cutoff, F.lit(False)))


# Where a column's values go when several columns share one long table: by kind of type, so that
# values keep their order and equality. Every decimal type is a kind of its own.
KINDS = {"whole": "bigint", "real": "double", "text": "string"}


def value_kind(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "whole"
    if isinstance(dtype, T.DecimalType):
        return f"decimal_{dtype.precision}_{dtype.scale}"
    return "real" if isinstance(dtype, (T.FloatType, T.DoubleType)) else "text"


def _kinds(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """The kinds of value table for these columns: field and type."""
    decimals = {t for t in (df.schema[c].dataType for c in cols) if isinstance(t, T.DecimalType)}
    return KINDS | {value_kind(t): t.simpleString() for t in sorted(decimals, key=str)}


def typed_value(df: DataFrame, name: str) -> Column:
    """A column as its kind's type, with every way of missing as NULL."""
    dtype = df.schema[name].dataType
    return present(name, dtype).cast(_kinds(df, [name])[value_kind(dtype)])


def value_groups(df: DataFrame, cols: list[str], label: str | None = None) -> DataFrame:
    """(col_name, given, whole, real, text[, decimal_p_s], n[, label_mean]) per column and distinct value.

    A value is in the field of its column's kind; ``given`` is false for the group of missing values.
    Columns are laid out long inside the scan's stage and aggregated there first, so one pass does
    for all columns, and a value held by a third of all rows leaves each task as one row.
    """
    kinds = _kinds(df, cols)

    def entry(c: str) -> Column:
        kind = value_kind(df.schema[c].dataType)
        return F.struct(F.lit(c).alias("col_name"), typed_value(df, c).isNotNull().alias("given"), *[
            (typed_value(df, c) if k == kind else F.lit(None).cast(kinds[k])).alias(k) for k in kinds
        ])
    keep = [] if label is None else [nan_to_null(F.col(label).cast("double")).alias("label")]
    long = df.select(*keep, F.inline(F.array(*[entry(c) for c in cols])))
    aggs = [F.count(F.lit(1)).alias("n")]
    if label is not None:
        aggs.append(F.avg("label").alias("label_mean"))
    return long.groupBy("col_name", "given", *kinds).agg(*aggs)


def has_value() -> Column:
    """True for the rows of ``value_groups`` that are not a column's group of missing values."""
    return F.col("given")


def cardinality_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_name, n_values, n_categories): distinct values without and with missing as a category."""
    return value_groups(df, list(cols)).groupBy("col_name").agg(
        F.count_if(has_value()).alias("n_values"),
        F.count(F.lit(1)).alias("n_categories"),
    )


def column_modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """The most frequent value of each column; the smallest one on a tie; None if all are missing."""
    best = value_groups(df, list(cols)).filter(has_value()).groupBy("col_name").agg(
        F.min(F.struct((-F.col("n")).alias("rank"), *_kinds(df, list(cols)))).alias("top")
    ).select("col_name", "top.*")
    found = {r["col_name"]: r[value_kind(df.schema[r["col_name"]].dataType)] for r in best.collect()}
    return {c: found.get(c) for c in cols}
