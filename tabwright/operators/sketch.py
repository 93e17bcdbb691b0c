"""Numbers of distinct values from sketches that are stored with each part of a table and merged later.

A new part is sketched alone: neither the values nor the other parts are read again. Sketches have a fixed size, whatever
the number of values, so the shuffle carries one of them per task, part and column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import nan_to_null

PRECISION = 14  # base-2 logarithm of a sketch's cells


def error_bound(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Relative error that an estimate stays below, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)


def distinct_sketches(df: DataFrame, part: Column, cols: list[str], precision: int = PRECISION) -> DataFrame:
    """(part, col_name, n, sketch): a sketch of the present values of each column in each part of the table.

    Values count as they print, so a column's sketch may be merged with that of another type of the same values.
    """
    value = {c: F.col(f"`{c}`") for c in cols}
    shown = {c: F.when(nan_to_null(v).isNotNull() if df.schema[c].dataType.simpleString() in ("double", "float") else v.isNotNull(), v.cast("string"))
             for c, v in value.items()}
    rows = df.select(part.alias("part"), *[shown[c].alias(f"v{i}") for i, c in enumerate(cols)])
    wide = rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(f"v{i}", F.lit(precision)).alias(f"s{i}") for i in range(len(cols))])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)]))
    return wide.select("part", "n", long.alias("x")).select("part", "x.col_name", "n", "x.sketch")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Keep sketches by part; a part that is sketched again replaces its own only."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def merged_distinct(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(*by, col_name, n, n_distinct): estimates over all parts, or over the parts of each group.

    Sketches of different precision are merged at the lower one.
    """
    keys = [*(by or []), "col_name"]
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(True))).alias("n_distinct"))
