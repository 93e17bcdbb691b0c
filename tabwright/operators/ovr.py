"""Linear classifiers for any number of labels: one logistic regression for each label against the rest."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.sources.durable import drop_copy, materialise

MOST_LABELS = 1000  # each is a fit of its own


class OneAgainstRest(Estimator):
    """A logistic regression per label, on one stored copy of the rows, several side by side.

    Labels may be of any type that orders. Two labels need one fit only, and one label none. Rows without a label are
    left out; no labels at all, or more than ``MOST_LABELS``, are a ValueError. The penalty is ``1 / c`` on the summed loss.
    """

    def __init__(self, label: str, c: float = 1.0, max_iter: int = 1000, parallelism: int = 4, input: str = "features"):
        super().__init__()
        self.label, self.c, self.max_iter, self.parallelism, self.input = label, c, max_iter, parallelism, input

    def _fit(self, df: DataFrame) -> OneAgainstRestModel:
        stored = materialise(df.select(F.col(self.label).alias("label"), F.col(self.input).alias("features")).where("label IS NOT NULL"))
        counts = stored.groupBy("label").count().limit(MOST_LABELS + 1).collect()
        if not 0 < len(counts) <= MOST_LABELS:
            raise ValueError(f"{len(counts)} labels; one to {MOST_LABELS} are possible")
        labels, rows = sorted(r["label"] for r in counts), sum(r["count"] for r in counts)
        machine = LogisticRegression(labelCol="is", maxIter=self.max_iter, regParam=1 / (self.c * rows), standardization=False)

        def one(value) -> tuple[np.ndarray, float]:
            fitted = machine.fit(stored.select((F.col("label") == F.lit(value)).cast("double").alias("is"), "features"))
            return fitted.coefficients.toArray(), float(fitted.intercept)

        own = labels if len(labels) > 2 else labels[1:]
        with ThreadPoolExecutor(self.parallelism) as pool:
            fits = list(pool.map(inheritable_thread_target(df.sparkSession)(one), own))
        drop_copy(stored)
        return OneAgainstRestModel(labels, fits, self.input)


class OneAgainstRestModel(Model):
    """``prediction``: the label with the highest score, the smallest on ties; ``probability``: scores in order of ``labels``, sum 1."""

    def __init__(self, labels: list, fits: list[tuple[np.ndarray, float]], input: str):
        super().__init__()
        self.labels, self.fits, self.input = labels, fits, input

    def _scores(self) -> list[Column]:
        if not self.fits:
            return [F.lit(1.0)]
        row = vector_to_array(self.input)
        margins = []
        for weights, intercept in self.fits:
            products = F.zip_with(row, F.lit([float(w) for w in weights]), lambda x, w: x * w)
            margins.append(F.aggregate(products, F.lit(intercept), lambda total, x: total + x))
        scores = [1 / (1 + F.exp(-m)) for m in margins]
        return scores if len(self.labels) > 2 else [1 - scores[0], scores[0]]

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("__scores", F.array(*self._scores()))
        total = F.aggregate("__scores", F.lit(0.0), lambda t, x: t + x)
        first = F.array_position("__scores", F.array_max("__scores")).cast("int")
        known = F.array(*[F.lit(v) for v in self.labels])
        return scored.withColumns({
            "probability": F.when(total > 0, F.transform("__scores", lambda x: x / total)).otherwise(F.col("__scores")),
            "prediction": F.get(known, first - 1),
        }).drop("__scores")
