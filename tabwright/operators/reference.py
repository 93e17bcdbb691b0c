"""Lookups in reference tables, by equal keys or by bands, and draws from looked-up rates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.functions import average_rates, hash01, nan_to_null, scale_by_ratio
from tabwright.operators.skew import spread_left_join
from tabwright.sources.durable import SMALL_ROWS, materialise, pin_small



def lookup(
    df: DataFrame, rates: DataFrame, on: dict[str, Column], small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Left join to a reference table: ``on`` maps each of its key columns to an expression of ``df``.

    Its keys must be unique (else ValueError) and are not part of the result; a row without a match
    gets NULL. The reference table is broadcast if it has at most ``small_rows`` rows; beyond that heavy keys
    are taken out of the shuffle, see ``spread_left_join``.
    """
    side, rows = pin_small(rates, small_rows)
    if rows is not None:
        repeated = len({tuple(r[k] for k in on) for r in rows}) < len(rows)
    else:
        repeated = bool(side.groupBy(*on).count().filter("count > 1").take(1))
    if repeated:
        raise ValueError(f"the reference table repeats a key of {list(on)}")
    side = side.withColumnsRenamed({k: f"__key_{k}" for k in on})
    renamed = {f"__key_{k}": expression for k, expression in on.items()}
    if rows is None:
        joined = spread_left_join(df, side, renamed)
    else:
        joined = df.join(F.broadcast(side), reduce(and_, [e == F.col(k) for k, e in renamed.items()]), "left")
    return joined.drop(*[f"__key_{k}" for k in on])


def band_lookup(
    df: DataFrame, bands: DataFrame, value: str, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Left join on ``lo <= value < hi``; a NULL ``hi`` is open. Bands that overlap are a ValueError.

    A missing value (NULL or NaN) is in no band, and a band that holds nothing (``hi <= lo``) has no rows.

    Of up to ``small_rows`` bands, a binary search in their sorted starts finds the one a value can be in, and its
    columns come from a broadcast by its place. More bands are merged with the rows along the line of values.
    """
    edges = {c: F.col(c).cast("double") for c in ("lo", "hi")}
    held = bands.withColumns(edges).where(F.col("hi").isNull() | (F.col("lo") < F.col("hi")))
    side, rows = pin_small(held, small_rows)
    if rows is None:
        return _merged_bands(df, side, value)
    by_start = sorted(rows, key=lambda r: (r["lo"] is not None, r["lo"] if r["lo"] is not None else 0.0))
    by_start = [r for r in by_start if r["lo"] is not None]
    for one, after in zip(by_start, by_start[1:]):
        if one["hi"] is None or one["hi"] > after["lo"]:
            raise ValueError("the bands overlap, so a row could match several")
    starts = [r["lo"] for r in by_start]
    place = {start: float(i) for i, start in enumerate(starts)}
    side = side.withColumnsRenamed({"lo": "__lo", "hi": "__hi"})
    side = side.join(
        F.broadcast(df.sparkSession.createDataFrame(list(place.items()) or [(0.0, 0.0)], "__start double, __band double")),
        F.col("__lo") == F.col("__start")).drop("__start")
    x = nan_to_null(F.col(f"`{value}`").cast("double"))
    if starts:
        # below the first start is -1; the search is over [-inf, first), [first, second), ...
        ends = [float("-inf"), *[s for s in starts if abs(s) < float("inf")], float("inf")]
        ends = ends if len(ends) > 2 else [float("-inf"), 0.0, float("inf")]
        found = Bucketizer(splits=ends, inputCol="__point", outputCol="__bucket")
        shift = 0.0 if starts[0] == float("-inf") else 1.0
        placed = found.transform(df.withColumn("__point", F.coalesce(x, F.lit(0.0)))).withColumn(
            "__at", F.when(x.isNotNull(), F.col("__bucket") - shift if len(starts) > 1 or shift else F.lit(0.0))).drop("__point", "__bucket")
    else:
        placed = df.withColumn("__at", F.lit(None).cast("double"))
    joined = placed.join(F.broadcast(side), F.col("__at") == F.col("__band"), "left")
    inside = F.col("__hi").isNull() | (x < F.col("__hi"))
    kept = [c for c in side.columns if c not in ("__lo", "__hi", "__band")]
    return joined.withColumns({c: F.when(inside, F.col(f"`{c}`")) for c in kept}).drop("__lo", "__hi", "__band", "__at")


def _merged_bands(df: DataFrame, bands: DataFrame, value: str) -> DataFrame:
    """``band_lookup`` for any number of bands: rows and starts of bands in one order, cut into ranges.

    In a range, a row's band is the last one that started before it; where none did, the last one of the ranges before.
    Equal values may fall into many ranges, so a common value is no hot spot. The order is stored once, because ranges
    cut anew would differ.
    """
    x = nan_to_null(F.col(f"`{value}`").cast("double"))
    own, others = [f"`{c}`" for c in df.columns], [c for c in bands.columns if c not in ("lo", "hi")]
    band = F.struct("lo", "hi", *[f"`{c}`" for c in others])
    row = F.struct(*own)
    nothing = {"band": F.lit(None).cast(bands.select(band.alias("b")).schema["b"].dataType),
               "row": F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType)}
    starts = bands.select(F.col("lo").alias("point"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("salt"), band.alias("band"),
                          nothing["row"].alias("row")).where(F.col("point").isNotNull())
    values = df.select(x.alias("point"), F.lit(1).alias("kind"), F.xxhash64(*[F.col(c).cast("string") for c in own]).alias("salt"),
                       nothing["band"].alias("band"), row.alias("row"))
    line = starts.unionByName(values).repartitionByRange("point", "kind", "salt").withColumn("range", F.spark_partition_id())
    line = materialise(line)

    along = Window.partitionBy("range").orderBy("point", "kind", "salt")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    last = line.groupBy("range").agg(F.max_by("band", "point").alias("last"))
    carried = last.select("range", F.last("last", ignorenulls=True).over(ranges).alias("carried"))
    told = line.join(F.broadcast(carried), "range")
    before = told.withColumn("before", F.lag("band").over(Window.partitionBy("range", "kind").orderBy("point")))
    clash = (F.col("before.hi").isNull() & F.col("before").isNotNull()) | (F.col("before.hi") > F.col("point")) | (
        F.col("before").isNull() & F.col("carried").isNotNull() & (F.col("carried.hi").isNull() | (F.col("carried.hi") > F.col("point"))))
    if not before.where((F.col("kind") == 0) & clash).isEmpty():
        raise ValueError("the bands overlap, so a row could match several")
    found = told.withColumn("near", F.coalesce(F.last("band", ignorenulls=True).over(upto), F.col("carried"))).where("kind = 1")
    inside = F.col("point").isNotNull() & (F.col("near.hi").isNull() | (F.col("point") < F.col("near.hi")))
    return found.select(
        *[F.col("row")[c].alias(c) for c in df.columns], *[F.when(inside, F.col("near")[c]).alias(c) for c in others])


def key_grid(spark: SparkSession, ages: int = 76) -> DataFrame:
    """(sex, age) for both sexes and ages 0 to ``ages - 1``: 152 rows by default."""
    age = spark.range(ages).select(F.col("id").cast("int").alias("age"))
    return age.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("sex"), "age")


def rate_grid(grid: DataFrame, bands: DataFrame, men_ratio: DataFrame) -> DataFrame:
    """(sex, age, smoke_rate): the mean of a band's two rates, times the one-row ratio for sex 1.

    ``bands`` has (lo, hi, rate1, rate2); an age outside every band has rate 0. ``men_ratio`` has one
    row with the column ``ratio``; another number of rows, or no ratio in it, is a ValueError.
    """
    ratio = men_ratio.agg(F.count(F.lit(1)).alias("n"), F.max("ratio").alias("ratio")).first()
    if ratio["n"] != 1 or ratio["ratio"] is None:
        raise ValueError(f"one ratio is needed, not {ratio['n']} rows with {ratio['ratio']}")
    placed = band_lookup(grid, bands, "age")
    mean = average_rates(F.col("rate1"), F.col("rate2"))
    return placed.select(
        "sex", "age", scale_by_ratio(mean, F.col("sex"), F.lit(ratio["ratio"])).alias("smoke_rate"),
    )


def prob_impute(
    df: DataFrame, rates: DataFrame, on: dict[str, Column], key: list[str], seed: int = 7,
    rate: str = "smoke_rate", out: str = "smoke",
) -> DataFrame:
    """Add ``out`` = 1 with the looked-up probability (in percent), else 0; NULL without a match.

    The draw is a hash of the seed and the row's ``key``, so it is the same on every run. The seed must
    not be that of a split by the same key, or the test rows would be those with low draws.
    """
    joined = lookup(df, rates.select(*on, rate), on)
    draw = hash01(seed, *key) * F.lit(100.0)
    hit = F.when(F.col(rate).isNotNull(), F.when(F.col(rate) <= draw, 0).otherwise(1))
    return joined.withColumn(out, hit.cast("int")).drop(rate)
