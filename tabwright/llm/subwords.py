"""Quality scores from supervised subword embeddings: averaged hashed vectors under a softmax, learnt by numpy SGD.

A text's features are its words, its pairs of neighbouring words (a word next to itself is one feature of
its own, whatever the word), and the runs of 3 to 5 characters within blank-delimited words, blanks
marking both ends. Each is hashed into ``buckets`` learnt vectors; the document is their average.
Labels 1 and 0 are learnt from a sample of at most ``sample`` labelled documents, chosen by a hash
of the id, with whole texts of at most ``longest`` characters: that is what reaches the driver. All
texts are scored, whole, in the tasks. There the two classes' output weights times the vectors are one
number per bucket, so a text's score is one gather and one mean.

Defined results: null and empty texts have no features and get the score of the bias alone; without
labelled rows every score is 0.5; labels that contradict each other are left out; documents without an
id are scored but never learnt from, and are not held out; repeated rows are scored alike.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.tokens import ODD, mixed, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 20  # characters whose features are made at a time


@dataclass(frozen=True)
class Training:
    buckets: int = 1 << 17
    size: int = 16
    steps: int = 20_000  # documents taken, the sample over and over
    rate: float = 8.0
    sample: int = 4000
    longest: int = 100_000
    seed: int = 5


def _char_runs(text: str) -> list[np.ndarray]:
    """Hashes of all runs of 3 to 5 characters without a blank inside; blanks in a row count once."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    keep = np.ones(len(points), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    blank = blank[keep]
    points = np.where(blank, np.uint32(32), points[keep]).astype(np.uint64)
    found = []
    for size in (3, 4, 5):
        n = len(points) - size + 1
        if n < 1:
            break
        total, inside = np.full(n, size, np.uint64), np.zeros(n, bool)
        for k in range(size):
            total += points[k: k + n] * ODD[k]
            if 0 < k < size - 1:
                inside |= blank[k: k + n]
        found.append(mixed(total[~inside]))
    return found


def features(text: str, buckets: int) -> np.ndarray:
    """Bucket of every feature of the text, with repeats."""
    words = word_hashes(text.encode("utf-8", "surrogatepass"))
    pairs = mixed(words[:-1] * ODD[10] + words[1:] * ODD[11])
    pairs[words[:-1] == words[1:]] = 1
    runs = [r for at in range(0, len(text), PIECE) for r in _char_runs(text[at: at + PIECE])]
    return (np.concatenate([words, pairs, *runs]) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """``weight`` of each bucket and ``bias``: their mean and sum are the log odds of label 1."""

    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        own = features(text or "", len(self.weight))
        odds = self.bias + (float(self.weight[own].mean()) if len(own) else 0.0)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def learn(texts: list[str], labels: list[int], training: Training = Training()) -> Model:
    """Stochastic gradient descent on the log loss, one document at a time."""
    rng = np.random.default_rng(training.seed)
    vectors = rng.uniform(-1, 1, (training.buckets, training.size)).astype(np.float32) / training.size
    out, bias = np.zeros((2, training.size), np.float32), np.zeros(2, np.float32)
    done = 0
    while done < training.steps:
        for i in rng.permutation(len(texts))[:training.steps - done]:
            rate = training.rate * (1 - done / training.steps)
            done += 1
            own, counts = np.unique(features(texts[i], training.buckets), return_counts=True)
            if not len(own):
                continue
            share = (counts / counts.sum()).astype(np.float32)
            mean = share @ vectors[own]
            odds = out @ mean + bias
            error = np.exp(odds - odds.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = error @ out
            out -= rate * np.outer(error, mean)
            bias -= rate * error
            vectors[own] -= rate * share[:, None] * back
    return Model((vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
          training: Training = Training()) -> Model:
    """The model of a bounded sample of the labelled documents that are not held out."""
    told = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")) \
        .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))) \
        .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("most")).where("y = most") \
        .orderBy(F.xxhash64("id"), "id").limit(training.sample).select("id", "y")
    own = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")) \
        .where(F.length("text") <= training.longest)
    rows = own.join(F.broadcast(told), "id").groupBy("id", "y").agg(F.min("text").alias("text")) \
        .orderBy("id").select("text", "y").toArrow()
    if not len(rows):
        return Model(np.zeros(training.buckets, np.float32), 0.0)
    return learn(rows["text"].to_pylist(), rows["y"].to_pylist(), training)


def score(text: Column, model: Model) -> Column:
    """Probability of label 1 of the whole text."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([float(model.score(t.as_py())) for t in texts], pa.float64())

    return scored.asNondeterministic()(text.cast("string"))
