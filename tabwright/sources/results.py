"""Scores of trained models: one long table, one partition per model, and the chosen model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS_SCHEMA = "branch string, metric string, value double, model string"


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Store (model, branch, metric, value) rows; a model trained again replaces its own rows only."""
    (
        metrics.select("branch", "metric", "value", "model").coalesce(1)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("model").parquet(path)
    )


def read_metrics(spark: SparkSession, path: str, models: list[str] | None = None) -> DataFrame:
    """Stored rows, optionally of some models only (prunes to their partitions)."""
    df = spark.read.schema(METRICS_SCHEMA).parquet(path)
    if models is not None:
        df = df.filter(F.col("model").isin(models))
    return df.select("model", "branch", "metric", "value")


def write_best(best: DataFrame, path: str) -> None:
    best.coalesce(1).write.mode("overwrite").parquet(path)


def read_best(spark: SparkSession, path: str) -> str:
    return spark.read.parquet(path).first()["model"]
