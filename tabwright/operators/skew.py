"""Joins with large reference tables whose keys are far from evenly used."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 4096  # keys that the sketch counts at a time
MOST_HEAVY = 256  # keys, and rows of the reference table, that are taken out of the shuffle
SHARE = 4  # a key is heavy from this part of a shuffle partition's even share on


def _hash(keys: list[Column]) -> Column:
    present = reduce(and_, [k.isNotNull() for k in keys])
    return F.when(present, F.xxhash64(*keys))


def heavy_keys(df: DataFrame, keys: list[Column], partitions: int) -> list[int]:
    """Hashes of the keys that hold more rows than a quarter of a partition should, at most ``MOST_HEAVY``.

    One pass with a frequent-items sketch, whose size does not grow with the rows.
    """
    hashed = df.select(_hash(keys).alias("h")).where("h IS NOT NULL")
    told = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {MOST_HEAVY}, {TRACKED})").alias("top")).first()
    return [t["item"] for t in told["top"] or [] if t["count"] * partitions * SHARE > told["n"]]


def spread_left_join(df: DataFrame, side: DataFrame, on: dict[str, Column]) -> DataFrame:
    """Left join with a table too large to broadcast, whose keys ``on`` are unique; they stay in the result.

    Rows with a heavy key meet the few reference rows of those keys in a broadcast and do not move, so no task gets all
    rows of a key, with or without adaptive execution. Rows without a key match nothing and do not move either. All others are shuffled.
    ``df`` is read twice, and a third time for the sketch.
    """
    condition = reduce(and_, [expression == F.col(f"`{k}`") for k, expression in on.items()])
    own = [expression.try_cast(side.schema[k].dataType) for k, expression in on.items()]
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(df, own, partitions)
    stays = _hash(own).isNull() | _hash(own).isin(heavy) if heavy else _hash(own).isNull()
    few = side.where(_hash([F.col(f"`{k}`") for k in on]).isin(heavy)) if heavy else side.where(F.lit(False))
    still = df.where(stays).join(F.broadcast(few), condition, "left")
    moved = df.where(~stays).join(side, condition, "left")
    return still.unionByName(moved)
