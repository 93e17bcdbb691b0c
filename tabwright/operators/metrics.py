"""Scores of predictions, and the choice of a model by its scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tabwright.functions import nan_to_null
from tabwright.sources.durable import materialise


def _ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 where nothing is there to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.try_divide(part.cast("double"), whole))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(F.lit(2.0) * precision * recall, precision + recall)


def _hits(label: str, prediction: str) -> dict[str, Column]:
    hit, said = F.col(label) == 1, F.col(prediction) == 1
    return {"tp": F.count_if(hit & said), "fp": F.count_if(~hit & said), "fn": F.count_if(hit & ~said)}


def _binary_scores(counts: DataFrame, *keep: str) -> DataFrame:
    return counts.select(
        *keep,
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    ).withColumn("f1_score", _f1(F.col("precision"), F.col("recall")))


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (precision, recall, f1_score) with 1 as the positive class."""
    return _binary_scores(df.agg(*[c.alias(name) for name, c in _hits(label, prediction).items()]))


def compare_models(df: DataFrame, label: str, predictions: dict[str, str]) -> DataFrame:
    """(model, branch, metric, value) for several models' prediction columns, from one pass.

    ``predictions`` maps a model's name, which tells its branch, to its column.
    """
    hits = {m: _hits(label, column) for m, column in predictions.items()}
    counted = df.agg(*[c.alias(f"{i}:{n}") for i, m in enumerate(hits) for n, c in hits[m].items()])
    rows = F.array(*[
        F.struct(F.lit(m).alias("model"), *[F.col(f"{i}:{n}").alias(n) for n in hits[m]]) for i, m in enumerate(hits)
    ])
    scores = _binary_scores(counted.select(F.inline(rows)), "model")
    long = scores.unpivot("model", ["precision", "recall", "f1_score"], "metric", "value")
    return long.select("model", route(F.col("model")).alias("branch"), "metric", "value")


def weighted_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row (precision, recall, f1_score): the per-class scores weighted by class size.

    The rows are reduced to the confusion matrix at once; everything after works on its cells.
    """
    cells = df.groupBy(F.col(label).alias("said_by_label"), F.col(prediction).alias("said_by_model")).agg(
        F.count(F.lit(1)).alias("n")
    )
    label_, model_, n = (F.col(c) for c in ("said_by_label", "said_by_model", "n"))
    zero = F.lit(0).cast("bigint")
    sides = cells.select(F.inline(F.array(
        F.struct(label_.cast("double").alias("class"), F.when(label_ == model_, n).otherwise(zero).alias("tp"),
                 n.alias("support"), zero.alias("predicted")),
        F.struct(model_.cast("double").alias("class"), zero.alias("tp"), zero.alias("support"), n.alias("predicted")),
    )))
    classes = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
    ).withColumns({
        "p": _ratio(F.col("tp"), F.col("predicted")), "r": _ratio(F.col("tp"), F.col("support")),
    }).withColumn("f", _f1(F.col("p"), F.col("r")))
    rows = F.sum("support")
    return classes.agg(*[
        _ratio(F.sum(F.col(c) * F.col("support")), rows).alias(name)
        for c, name in (("p", "precision"), ("r", "recall"), ("f", "f1_score"))
    ])


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row (auc): exact area under the ROC curve, tied scores sharing their rank.

    The rows are read once and reduced to one per distinct score, which are stored in ranges of scores. The number of
    negatives below a score is a sum inside its range plus the totals of the ranges before, so no task ranks all
    scores. Infinite scores rank as such. Without positives or without negatives the area is NULL.
    """
    scored = df.select(
        nan_to_null(F.col(f"`{score}`").cast("double")).alias("score"), (F.col(f"`{label}`") == 1).alias("hit")
    ).filter(F.col("score").isNotNull() & F.col("hit").isNotNull())
    per_score = scored.groupBy((F.col("score") + 0.0).alias("score")).agg(
        F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"),
    )
    ranged = materialise(per_score.repartitionByRange("score").withColumn("range", F.spark_partition_id()))

    totals = ranged.groupBy("range").agg(F.sum("neg").alias("range_neg"), F.sum("pos").alias("range_pos"))
    everywhere = Window.partitionBy(F.lit(0))  # one row per range
    before = everywhere.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    below = totals.select(
        "range", F.coalesce(F.sum("range_neg").over(before), F.lit(0)).alias("below"),
        (F.sum("range_pos").over(everywhere) * F.sum("range_neg").over(everywhere).cast("double")).alias("pairs"),
    )
    within = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("passed", F.coalesce(F.sum("neg").over(within), F.lit(0)))
    return ranked.join(F.broadcast(below), "range").agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("passed") + F.col("neg") / 2)).alias("wins"),
        F.max("pairs").alias("pairs"),
    ).select(F.try_divide("wins", "pairs").alias("auc"))


def fold_accuracy(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """(fold, n, accuracy) per fold."""
    right = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def mean_fold_accuracy(df: DataFrame, label: str, prediction: str, fold: str) -> DataFrame:
    """One row (mean_accuracy): folds count alike, whatever their size."""
    return fold_accuracy(df, label, prediction, fold).agg(F.avg("accuracy").alias("mean_accuracy"))


def metrics_long(scores: DataFrame, model: str, branch: str) -> DataFrame:
    """One row of scores as (model, branch, metric, value) rows."""
    return scores.unpivot([], list(scores.columns), "metric", "value").select(
        F.lit(model).alias("model"), F.lit(branch).alias("branch"), "metric", "value",
    )


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def route(model: Column) -> Column:
    """The branch a model name belongs to, found in the name itself."""
    out = F.lit(None).cast("string")
    for branch in ("scrape", "sklearn", "spark"):
        out = F.when(model.contains(branch), F.lit(branch)).otherwise(out)
    return out


def best_model(metrics: DataFrame, order: list[str], by: str = "f1_score") -> DataFrame:
    """The row (model, branch, value) with the highest ``by``; on a tie the model first in ``order``."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return (
        metrics.filter((F.col("metric") == by) & F.col("model").isin(order))
        .orderBy(F.col("value").desc_nulls_last(), place)
        .limit(1)
        .select("model", route(F.col("model")).alias("branch"), "value")
    )
