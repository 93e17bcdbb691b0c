"""Random forests grown from counts of rows whose features fall into the same bins.

Spark's forest cuts every feature into at most 32 bins before it grows a tree, and all that a tree asks of the rows is how many of each label
are in which bins. It still visits each row once for every tree and level. Here the rows are counted by (bins, label) in one pass, and a task
grows a tree from the counts: the drawn weight of ``n`` equal rows, each with a Poisson weight of mean 1, is one Poisson draw of mean ``n``. So the
trees are drawn from the same distribution as Spark's, by other random numbers, which depend on the seed and the counts only. The bins of a large
table end at approximate quantiles, which may move a little with its file layout and from run to run, and the trees with them.
"""

from __future__ import annotations

import sys
import threading
from functools import partial
from math import ceil, prod, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.sources.durable import drop_folder, scratch_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32  # of a feature, as Spark's default
CELLS = 1 << 21  # most pairs of bins and label that are counted; a table with more is left to Spark's forest
ACCURACY = 10_000  # of the quantiles that cut a feature
PART = 64 << 20  # bytes that Spark's forest keeps of one part of its rows, at 500 bytes a row
ALONE = threading.Lock()  # such a fit keeps all rows in memory, so it runs alone

NODE = "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, " \
    "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"


class CountedForest(Estimator):
    """A forest for labels 0, 1, ...; ``fit`` returns Spark's own model.

    Every tree has a Poisson draw of the rows, every node the square root of the number of features to choose from, as Spark's. The bins come from the
    quantiles of all rows, or from all values of a feature that has no more than ``BINS``. Where the bins and labels make more than ``CELLS`` cells, Spark's forest is fitted.
    """

    def __init__(self, label: str, trees: int = 100, depth: int = 5, seed: int = 0, features: str = "features"):
        super().__init__()
        self.label, self.trees, self.depth, self.seed, self.features = label, trees, depth, seed, features

    def _spark(self) -> RandomForestClassifier:
        return RandomForestClassifier(labelCol=self.label, featuresCol=self.features, numTrees=self.trees, maxDepth=self.depth, seed=self.seed)

    def _fit(self, df: DataFrame) -> Model:
        rows = df.select(F.col(f"`{self.label}`").cast("double").alias("label"), vector_to_array(F.col(f"`{self.features}`")).alias("x"))
        cuts, labels, n = feature_cuts(rows)
        if prod(len(c) + 1 for c in cuts) * labels > CELLS:
            with ALONE:
                return self._spark().fit(df.repartition(max(1, -(-n * 500 // PART))))
        bins, counts = cell_counts(rows, cuts, labels)
        grown = df.sparkSession.range(0, self.trees, 1, self.trees).mapInArrow(
            partial(_grown, bins, counts, cuts, self.depth, self.seed, ceil(sqrt(len(cuts)))), NODE)
        # the model is put together by Spark: that of a few rows is saved, and read with the grown trees
        few = df.sparkSession.createDataFrame(
            [(float(k), Vectors.dense([float(k)] * len(cuts))) for k in range(labels)], [self.label, self.features])
        path = scratch_folder(df.sparkSession)
        self._spark().fit(few.coalesce(1)).save(path)
        grown.write.mode("overwrite").parquet(f"{path}/data")
        model = RandomForestClassificationModel.load(path)
        drop_folder(df.sparkSession, path)
        return model


def feature_cuts(rows: DataFrame) -> tuple[list[np.ndarray], int, int]:
    """(sorted cuts of each feature, number of labels, number of rows) of a frame (label, x); a bin ends with its cut."""
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        raise ValueError("no rows to grow trees from")
    x = [F.get("x", F.lit(k)) for k in range(first["n"])]
    shares = [k / BINS for k in range(1, BINS)]
    told = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max("label").alias("most"), F.min("label").alias("least"), F.count_if(F.col("label") != F.floor("label")).alias("broken"),
        F.count("label").alias("labelled"),
        *[F.percentile_approx(c, shares, ACCURACY).alias(f"q{k}") for k, c in enumerate(x)],
        *[F.approx_count_distinct(c).alias(f"d{k}") for k, c in enumerate(x)]).first()
    if told["labelled"] < told["n"] or told["least"] < 0 or told["broken"]:
        raise ValueError("labels must be 0, 1, ...")
    cuts = [np.unique(np.array(told[f"q{k}"], np.float64)) for k in range(len(x))]
    few = [k for k in range(len(x)) if told[f"d{k}"] <= 2 * BINS]
    if few:  # features whose values can all be told apart
        pairs = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), x[k].alias("v")) for k in few])).alias("p")).select("p.*").distinct().collect()
        for k in few:
            values = np.sort(np.array([p["v"] for p in pairs if p["k"] == k], np.float64))  # NaN, which goes right at any cut, comes last
            if len(values) <= BINS:
                cuts[k] = (values[:-1] + values[1:]) / 2
    return [c[~np.isnan(c)] for c in cuts], int(told["most"]) + 1, told["n"]


def _codes(cuts: list[np.ndarray], x: pa.Array) -> np.ndarray:
    """The cell of each row, a number of mixed base out of its bins."""
    values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(cuts))
    code = np.zeros(len(x), np.int64)
    for k, cut in enumerate(cuts):
        code = code * (len(cut) + 1) + np.searchsorted(cut, values[:, k])
    return code


def _counted(cuts: list[np.ndarray], labels: int, batches):
    """(cell, n) of a task's rows; the label is the last digit of the cell."""
    total = None
    for batch in batches:
        if total is None:
            total = np.zeros(prod(len(c) + 1 for c in cuts) * labels, np.int64)
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        np.add.at(total, _codes(cuts, batch.column("x")) * labels + label, 1)
    if total is not None:
        cell = np.flatnonzero(total)
        for at in range(0, len(cell), 1 << 16):
            some = cell[at: at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])


def cell_counts(rows: DataFrame, cuts: list[np.ndarray], labels: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, counts): the bins of each cell that has rows, and how many of each label."""
    told = rows.mapInArrow(partial(_counted, cuts, labels), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cell, n = (told.column(c).to_numpy() for c in ("cell", "n"))
    code, at = np.unique(cell // labels, return_inverse=True)
    counts = np.zeros((len(code), labels), np.int64)
    counts[at, cell % labels] = n
    bins = np.empty((len(code), len(cuts)), np.uint8)
    for k in reversed(range(len(cuts))):
        code, bins[:, k] = np.divmod(code, len(cuts[k]) + 1)
    return bins, counts


def _gini(stats: np.ndarray, total: np.ndarray) -> np.ndarray:
    return 1 - ((stats / np.maximum(total, 1)[..., None]) ** 2).sum(axis=-1)


def grow(bins: np.ndarray, counts: np.ndarray, cuts: list[np.ndarray], depth: int, choices: int, rng: np.random.Generator) -> list[dict]:
    """The nodes of one tree, level by level: its weights by label, and of one that is split the feature, the cut, the gain and the left child (the right one follows)."""
    weight = rng.poisson(counts).astype(np.float64)
    drawn = weight.any(axis=1)
    bins, weight = bins[drawn], weight[drawn]
    labels = weight.shape[1]
    nodes = [{"stats": weight.sum(axis=0)}]
    of, level = np.zeros(len(bins), np.int64), [0]  # the place of each cell's node in the level; -1 in a leaf
    for _ in range(depth):
        stats = np.array([nodes[k]["stats"] for k in level])
        total = stats.sum(axis=1)
        impurity = _gini(stats, total)
        chosen = np.zeros((len(level), len(cuts)), bool)
        np.put_along_axis(chosen, rng.random(chosen.shape).argsort(axis=1)[:, :choices], True, axis=1)
        best = np.zeros(len(level))
        feature, cut, left = np.full(len(level), -1), np.zeros(len(level), np.int64), np.zeros_like(stats)
        for f in range(len(cuts)):
            width = len(cuts[f]) + 1
            if width == 1 or not chosen[:, f].any():
                continue
            at = of * width + bins[:, f]
            held = np.stack([np.bincount(at, weight[:, k], minlength=len(level) * width) for k in range(labels)], axis=-1)
            below = held.reshape(len(level), width, labels).cumsum(axis=1)[:, :-1]
            above = stats[:, None] - below
            n, m = below.sum(axis=-1), above.sum(axis=-1)
            whole = np.maximum(total, 1)[:, None]
            gain = impurity[:, None] - n / whole * _gini(below, n) - m / whole * _gini(above, m)
            gain[(n == 0) | (m == 0) | ~chosen[:, f, None]] = -1
            top = gain.argmax(axis=1)
            most = gain[np.arange(len(level)), top]
            better = most > best
            best[better], feature[better], cut[better] = most[better], f, top[better]
            left[better] = below[better, top[better]]
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        after = []
        for k in split.tolist():
            node = nodes[level[k]]
            node |= {"feature": int(feature[k]), "cut": int(cut[k]), "gain": float(best[k]), "left": len(nodes)}
            after += [len(nodes), len(nodes) + 1]
            nodes += [{"stats": left[k]}, {"stats": stats[k] - left[k]}]
        goes = np.full(len(level), -1)
        goes[split] = np.arange(len(split))
        stay = goes[of] >= 0
        bins, weight, of = bins[stay], weight[stay], of[stay]
        right = bins[np.arange(len(bins)), feature[of]] > cut[of]
        of, level = 2 * goes[of] + right, after
    return nodes


def listed(nodes: list[dict], cuts: list[np.ndarray]) -> list[dict]:
    """The nodes as Spark stores them, in preorder; two leaves with one prediction are one, as in Spark's forest."""
    def merged(k: int) -> bool:
        """Whether node k is a leaf, or all leaves below it predict the same."""
        node = nodes[k]
        node["prediction"] = int(node["stats"].argmax())
        if "left" not in node:
            return True
        both = [merged(node["left"] + side) for side in (0, 1)]
        if all(both) and nodes[node["left"]]["prediction"] == nodes[node["left"] + 1]["prediction"]:
            node["prediction"] = nodes[node["left"]]["prediction"]
            del node["left"]
            return True
        return False

    def walk(k: int) -> None:
        node, row = nodes[k], {}
        total = node["stats"].sum()
        rows.append(row)
        row |= {"id": len(rows) - 1, "prediction": float(node["prediction"]), "impurity": float(_gini(node["stats"], total)), "impurityStats": node["stats"].tolist(),
                "rawCount": int(total), "gain": -1.0, "leftChild": -1, "rightChild": -1,
                "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}}
        if "left" in node:
            threshold = float(cuts[node["feature"]][node["cut"]])
            row |= {"gain": node["gain"], "split": {"featureIndex": node["feature"], "leftCategoriesOrThreshold": [threshold], "numCategories": -1}, "leftChild": len(rows)}
            walk(node["left"])
            row["rightChild"] = len(rows)
            walk(node["left"] + 1)

    rows: list[dict] = []
    merged(0)
    walk(0)
    return rows


def _grown(bins, counts, cuts, depth, seed, choices, batches):
    for batch in batches:
        for tree in batch.column("id").to_pylist():
            rows = listed(grow(bins, counts, cuts, depth, choices, np.random.default_rng([seed, tree])), cuts)
            kind = pa.struct([
                ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()),
                ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())]))])
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(rows), pa.int32()), pa.array(rows, kind)], names=["treeID", "nodeData"])
