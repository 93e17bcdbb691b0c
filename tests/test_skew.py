"""Joins with large tables and a key that a third of all rows hold."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.operators import skew


@pytest.fixture
def plain_shuffles(spark):
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 4001)
    return spark.range(0, n, 1, 16).select("id", key.cast("int").alias("k"), (F.col("id") % 2).cast("double").alias("y"))


def by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_no_task_of_a_lookup_gets_a_heavy_key(spark, plain_shuffles):
    df = hot_rows(spark)
    reference = spark.range(4000).selectExpr("id AS key", "id * 2 AS twice")
    out = op.lookup(df, reference, {"key": F.col("k")}, small_rows=100)
    sizes = by_task(out)
    assert max(sizes) <= 4 * median(sizes) and sum(sizes) == 60_000
    assert max(by_task(df.join(reference, F.col("k") == F.col("key"), "left"))) > 10_000  # as it would be
    assert out.columns == ["id", "k", "y", "twice"]
    assert out.where("twice IS DISTINCT FROM IF(k < 4000, k * 2, NULL)").isEmpty()


def test_no_task_of_an_encoding_gets_a_heavy_category(spark, plain_shuffles):
    df = hot_rows(spark)
    out = op.TargetEncode(["k"], "y", literal_rows=10, small_rows=100).fit(df).transform(df)
    assert max(by_task(out)) <= 4 * median(by_task(out))
    means = {r.k: r.m for r in df.groupBy("k").agg(F.avg("y").alias("m")).collect()}
    got = out.join(df.select("id", "k"), "id").select("k", "k_target").distinct().collect()
    assert len(got) == len(means) and all(r.k_target == (None if r.k is None else means[r.k]) for r in got)


def test_heavy_keys(spark):
    df = hot_rows(spark)
    five = spark.range(1).select(F.xxhash64(F.lit(5).cast("int")).alias("h")).first()["h"]
    assert skew.heavy_keys(df, [F.col("k")], 16) == [five]
    assert skew.heavy_keys(df.limit(0), [F.col("k")], 16) == []
    assert skew.heavy_keys(df.where("k IS NULL"), [F.col("k")], 16) == []


def test_keys_of_other_types_and_two_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (3, None)] * 40, "x int, s string")
    side = spark.createDataFrame([(1.0, "a", 10), (2.0, "a", 20), (2.5, "a", 30), (None, "a", 40)], "dx double, ds string, v int")
    out = op.lookup(df, side, {"dx": F.col("x"), "ds": F.col("s")}, small_rows=1)
    assert {(r.x, r.s, r.v) for r in out.collect()} == {(1, "a", 10), (1, "b", None), (2, "a", 20), (None, "a", None), (3, None, None)} and out.count() == 200
    wide = spark.createDataFrame([(1.5,), (1.0,), (1e30,)], "x double")
    out = op.lookup(wide, spark.createDataFrame([(1, 7), (2, 8)], "k int, v int"), {"k": F.col("x")}, small_rows=1)
    assert sorted((r.x, r.v) for r in out.collect()) == [(1.0, 7), (1.5, None), (1e30, None)]
