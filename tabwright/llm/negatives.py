"""Hard negatives of anchors: exact windows of inner products, found in cover trees of norm-augmented rows.

Vectors become whole numbers, so scores are exact. A candidate x gets one more entry sqrt(M - |x|**2), where M is
the greatest squared length; an anchor q gets a zero. All candidates then have the same length, and the squared distance
of q and x is |q|**2 + M - 2 * score, so a ball around a candidate bounds the scores of all rows in it.

* Pivots, at most ``PIVOTS``, are chosen farthest first from a bounded sample. Every row goes to its nearest pivot, and rows are stored in
  order of pivots; a pivot with very many rows spreads over as many partitions as it needs.
* A task reads blocks of such rows and builds a cover tree over each: a node's centre is a row, its first child has
  the same centre, further children are the rows farthest from those before, until all rows are within half of the node's
  radius or ``FAN`` children are there. Every node keeps the distance of its farthest row.
* An anchor descends best first: the node with the highest possible score is opened next. Nodes whose scores lie outside all
  windows, or below what is already found, are skipped; the rows of leaves are compared exactly.
* The pivot of an anchor is searched first. What is found there bounds the search of all others, and whole pivots that cannot
  reach the bound are not read.

Positives are the first rows of the same label; each positive's score makes one window for the negatives. Anchors are taken
in batches of at most ``BATCH``, which are broadcast: the one thing that reaches the driver, with at most ``positives`` of each.

Defined results: rows without an id, label or vector, or with an entry that is null, NaN or infinite, take no part; nor
do those of another length than most rows (of equally common lengths the greatest counts), empty vectors and vectors of a squared
length of 2**55 or more, whose scores could overflow. Rows equal in id, label and vector are one row; other rows
that share an id are rows of their own. Ties go to the smaller id. Anchors without positives, and positives without negatives in
their window, give no rows; a negative positive's window is empty. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm import vectors
from tabwright.sources.durable import drop_copy, materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 1024  # most pivots
PIVOT_ROWS = 4096  # rows wanted for each, as long as there are fewer
SAMPLE = 16_384  # rows that pivots are chosen from
LEAF = 256  # rows of a leaf
FAN = 8  # children of a node
BATCH = 50_000  # anchors that are broadcast at a time
SLICE = 2048  # anchors whose bounds are computed at a time
LOWEST, HIGHEST = -(1 << 62), 1 << 62
EXACT = 1 << 53  # products of lengths below it are exact in doubles


@dataclass(frozen=True)
class Plan:
    positives: int = 5
    negatives: int = 5
    least: int = 80  # percent of the positive's score
    most: int = 100


@dataclass(frozen=True)
class Request:
    """Anchors and, for each, windows of scores: ``low`` to ``high``, of which only scores from ``floor`` on are news."""

    ids: np.ndarray
    labels: np.ndarray
    pivots: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray
    same: bool  # rows of the anchor's own label, or of all others
    k: int  # rows wanted in each window


class CoverTree:
    """Rows of one block, in order of leaves. ``square`` is the squared length of every augmented row."""

    def __init__(self, rows: np.ndarray, square: float, ids: np.ndarray, labels: np.ndarray):
        self.square = square
        self._points = rows.astype(np.float64)
        self._extra = np.sqrt(np.maximum(square - (self._points ** 2).sum(axis=1), 0))
        self.slack = 1e-7 * np.sqrt(square) + 1e-9  # more than the error of a distance
        centres: list[int] = []
        self.radii: list[float] = []
        self.children: list[list[int]] = []
        self.leaves: list[slice | None] = []
        order, done = [], 0
        everything = np.arange(len(rows))
        waiting = [(everything, 0, self._apart(0, everything), -1)]
        while waiting:
            members, centre, apart, parent = waiting.pop()
            node = len(centres)
            centres.append(centre)
            self.radii.append(float(apart.max()) + self.slack)
            self.children.append([])
            self.leaves.append(None)
            if parent >= 0:
                self.children[parent].append(node)
            if len(members) <= LEAF or apart.max() <= self.slack:
                order.append(members)
                self.leaves[node] = slice(done, done + len(members))
                done += len(members)
            else:
                waiting += [(*part, node) for part in self._cover(members, centre, apart)]
        self.centres = self._points[centres]
        order = np.concatenate(order)
        self.rows, self.ids, self.labels, self._points = rows[order], ids[order], labels[order], self._points[order]

    def scores(self, own: np.ndarray, leaf: slice) -> np.ndarray:
        """Exact products of an anchor with the rows of a leaf."""
        as_double = own.astype(np.float64)
        if float(as_double @ as_double) * self.square < float(EXACT) ** 2 / 2:
            return self._points[leaf] @ as_double
        return self.rows[leaf] @ own

    def _apart(self, centre: int, members: np.ndarray) -> np.ndarray:
        near = self._points[members] @ self._points[centre] + self._extra[members] * self._extra[centre]
        apart = np.sqrt(np.maximum(2 * self.square - 2 * near, 0))
        apart[members == centre] = 0
        return apart

    def _cover(self, members: np.ndarray, centre: int, apart: np.ndarray) -> list[tuple[np.ndarray, int, np.ndarray]]:
        half = apart.max() / 2
        centres, owner, near = [centre], np.zeros(len(members), np.int64), apart
        while len(centres) < FAN and near.max() > max(half, self.slack):
            far = int(near.argmax())
            other = self._apart(int(members[far]), members)
            closer = other < near
            owner[closer] = len(centres)
            near = np.where(closer, other, near)
            centres.append(int(members[far]))
        return [(members[owner == k], c, near[owner == k]) for k, c in enumerate(centres)]

    def bounds(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, greatest) score that each anchor can have with the rows of each node."""
        own = (anchors.astype(np.float64) ** 2).sum(axis=1)[:, None] + self.square
        apart = np.sqrt(np.maximum(own - 2 * (anchors.astype(np.float64) @ self.centres.T), 0))
        radii = np.array(self.radii)
        error = 1e-9 * own + 1
        greatest = (own - np.maximum(apart - radii - self.slack, 0) ** 2) / 2 + error
        return (own - (apart + radii + self.slack) ** 2) / 2 - error, greatest


class Found:
    """The first ``k`` rows of every window of every anchor so far."""

    def __init__(self, request: Request):
        self.request = request
        shape = (*request.low.shape, request.k)
        self.scores, self.ids = np.full(shape, LOWEST, np.int64), np.full(shape, HIGHEST, np.int64)
        self.need = np.maximum(request.low, request.floor)

    def add(self, anchor: int, scores: np.ndarray, ids: np.ndarray) -> None:
        request = self.request
        near = (scores >= self.need[anchor].min()) & (scores <= request.high[anchor].max())
        if not near.any():
            return
        scores, ids = scores[near].astype(np.int64), ids[near]
        for w in range(request.low.shape[1]):
            fits = (scores >= self.need[anchor, w]) & (scores <= request.high[anchor, w])
            if not fits.any():
                continue
            all_scores = np.r_[self.scores[anchor, w], scores[fits]]
            all_ids = np.r_[self.ids[anchor, w], ids[fits]]
            first = np.lexsort((all_ids, -all_scores))[:request.k]
            self.scores[anchor, w], self.ids[anchor, w] = all_scores[first], all_ids[first]
            self.need[anchor, w] = max(self.need[anchor, w], self.scores[anchor, w, -1])

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(anchor, window, score, id); ``anchor`` is its place in the request."""
        at = np.argwhere(self.scores > LOWEST)
        for start in range(0, len(at), 65_536):
            a, w, k = at[start: start + 65_536].T
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), pa.array(w), pa.array(self.scores[a, w, k]), pa.array(self.ids[a, w, k])], ["anchor", "window", "score", "id"])


def descend(tree: CoverTree, request: Request, anchors: np.ndarray, found: Found) -> None:
    """Search the rows of a tree for some anchors of a request, best nodes first."""
    for start in range(0, len(anchors), SLICE):
        some = anchors[start: start + SLICE]
        least, greatest = tree.bounds(request.rows[some])
        for i, anchor in enumerate(some.tolist()):
            _best_first(tree, request, anchor, least[i].tolist(), greatest[i].tolist(), found)


def _best_first(tree: CoverTree, request: Request, anchor: int, least: list[float], greatest: list[float], found: Found) -> None:
    need, high, own = found.need[anchor], request.high[anchor], request.rows[anchor]
    wanted = [(float(n), float(h)) for n, h in zip(need.tolist(), high.tolist()) if n <= h]
    waiting = [(-greatest[0], 0)]
    while waiting:
        top, node = heapq.heappop(waiting)
        if not any(-top >= n and least[node] <= h for n, h in wanted):
            continue  # outside all windows
        leaf = tree.leaves[node]
        if leaf is None:
            for child in tree.children[node]:
                heapq.heappush(waiting, (-greatest[child], child))
            continue
        scores = tree.scores(own, leaf)
        fits = (scores >= min(n for n, _ in wanted)) & ((tree.labels[leaf] == request.labels[anchor]) == request.same)
        at = np.flatnonzero(fits)
        if request.same:  # an anchor is not its own positive
            at = at[[tree.ids[leaf][k] != request.ids[anchor] or not np.array_equal(tree.rows[leaf][k], own) for k in at.tolist()]]
        if len(at):
            found.add(anchor, scores[at], tree.ids[leaf][at])
            wanted = [(float(n), float(h)) for n, h in zip(need.tolist(), high.tolist()) if n <= h]


def _search(index: DataFrame, request, square: float, width: int, home: bool) -> DataFrame:
    """(anchor, window, score, id): the first rows of each window, from each task's blocks, then from all."""
    def task(batches):
        wanted: Request = request.value
        found = Found(wanted)
        for batch in batches:
            ids, labels, pivots = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            rows = vectors.matrix(batch.column(3), width)
            for pivot in np.unique(pivots):
                own = pivots == pivot
                anchors = np.flatnonzero(wanted.pivots == pivot) if home else np.arange(len(wanted.ids))
                if len(anchors):
                    descend(CoverTree(rows[own], square, ids[own], labels[own]), wanted, anchors, found)
        yield from found.rows()

    parts = index.select("id", "label", "pivot", "v").mapInArrow(task, "anchor long, window long, score long, id long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= request.value.k)


def usable_rows(df: DataFrame, id: str, label: Column, vector: str, times: int) -> DataFrame:
    """(id, label, v) of the rows that take part, with whole vectors; equal rows are one."""
    rows = df.where(F.col(f"`{id}`").isNotNull() & label.isNotNull() & vectors.is_whole(F.col(f"`{vector}`"))).select(
        F.col(f"`{id}`").cast("long").alias("id"), label.cast("long").alias("label"), vectors.floored(F.col(f"`{vector}`"), times).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    return rows.where((F.size("v") > 0) & (square < float(1 << 55))).groupBy("id", "label", "v").agg(square.alias("square"))


def choose_pivots(sample: np.ndarray, count: int, square: float) -> np.ndarray:
    """Rows of the sample, each the farthest from those before it."""
    points = sample.astype(np.float64)
    extra = np.sqrt(np.maximum(square - (points ** 2).sum(axis=1), 0))
    chosen, near = [0], np.full(len(points), np.inf)
    while len(chosen) < min(count, len(points)):
        last = chosen[-1]
        near = np.minimum(near, 2 * square - 2 * (points @ points[last] + extra * extra[last]))
        near[last] = -1
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    return sample[chosen]


def build_index(rows: DataFrame, width: int, n: int, square: float) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(rows with their pivot in order of pivots, the pivots, the radius around each)."""
    sample = rows.orderBy(F.xxhash64("id", "label", "v"), "id").limit(SAMPLE).select("v").toArrow()
    pivots = choose_pivots(vectors.matrix(sample["v"].combine_chunks(), width), min(PIVOTS, -(-n // PIVOT_ROWS)), square)
    points = pivots.astype(np.float64)
    extra = np.sqrt(np.maximum(square - (points ** 2).sum(axis=1), 0))

    def nearest(batches):
        for batch in batches:
            own = vectors.matrix(batch.column(2), width).astype(np.float64)
            own_extra = np.sqrt(np.maximum(square - (own ** 2).sum(axis=1), 0))
            near = own @ points.T + own_extra[:, None] * extra
            pivot = near.argmax(axis=1)
            apart = np.sqrt(np.maximum(2 * square - 2 * near[np.arange(len(own)), pivot], 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(apart)], ["id", "label", "v", "pivot", "apart"])

    placed = rows.select("id", "label", "v").mapInArrow(nearest, "id long, label long, v array<long>, pivot long, apart double")
    index = materialise(placed.repartitionByRange("pivot", F.xxhash64("id", "v")).sortWithinPartitions("pivot"))
    radii = np.zeros(len(pivots))
    for r in index.groupBy("pivot").agg(F.max("apart").alias("apart")).collect():  # one row per pivot
        radii[r["pivot"]] = r["apart"]
    return index, pivots, radii


def _reached(index: DataFrame, request: Request, pivots: np.ndarray, radii: np.ndarray, square: float) -> DataFrame:
    """The index without the pivots that cannot hold a row for any window."""
    tree = object.__new__(CoverTree)
    tree.square, tree.slack, tree.centres = square, 1e-7 * np.sqrt(square) + 1e-9, pivots.astype(np.float64)
    tree.radii = (radii + tree.slack).tolist()
    used = np.zeros(len(pivots), bool)
    need = np.maximum(request.low, request.floor)
    for start in range(0, len(request.ids), SLICE):
        some = slice(start, start + SLICE)
        least, greatest = tree.bounds(request.rows[some])
        for w in range(need.shape[1]):
            n, h = need[some, w, None], request.high[some, w, None]
            used |= ((n <= h) & (greatest >= n) & (least <= h)).any(axis=0)
    return index if used.all() else index.where(F.col("pivot").isin(np.flatnonzero(used).tolist()))


def _tables(rows: pa.Table, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.full(shape, LOWEST, np.int64), np.full(shape, HIGHEST, np.int64)
    a, w, r, s, i = (rows[c].to_numpy() for c in ("anchor", "window", "rank", "score", "id"))
    scores[a, w, r - 1], ids[a, w, r - 1] = s, i
    return scores, ids


def _windows(index: DataFrame, request: Request, pivots: np.ndarray, radii: np.ndarray, square: float) -> DataFrame:
    """All rows of the request's windows: the anchors' own pivots first, then whatever could still be better."""
    spark, width = index.sparkSession, request.rows.shape[1]
    near = _search(index, spark.sparkContext.broadcast(request), square, width, True)
    near = near.where(F.col("rank") == request.k).select("anchor", "window", "score").toArrow()  # at most one for each window
    floor = request.floor.copy()
    floor[near["anchor"].to_numpy(), near["window"].to_numpy()] = near["score"].to_numpy()
    bounded = replace(request, floor=floor)
    return _search(_reached(index, bounded, pivots, radii, square), spark.sparkContext.broadcast(bounded), square, width, False)


def _of_batch(index: DataFrame, anchors: pa.Table, pivots: np.ndarray, radii: np.ndarray, square: float, plan: Plan) -> DataFrame:
    m, width = len(anchors), pivots.shape[1]
    own = {c: anchors[c].to_numpy() for c in ("id", "label", "pivot")}
    everything = np.full((m, 1), LOWEST + 1, np.int64)
    request = Request(own["id"], own["label"], own["pivot"], vectors.matrix(anchors["v"].combine_chunks(), width),
                      everything, np.full((m, 1), HIGHEST, np.int64), everything, True, plan.positives)
    found = _windows(index, request, pivots, radii, square).toArrow()  # at most ``positives`` for each anchor of the batch
    scores, ids = (t[:, 0, :] for t in _tables(found, (m, 1, plan.positives)))
    there = scores > LOWEST
    safe = np.where(there, scores, 0)
    low = np.where(there, -(-(plan.least * safe) // 100), HIGHEST)
    high = np.where(there, (plan.most * safe) // 100, LOWEST)
    request = replace(request, low=low, high=high, floor=np.full(low.shape, LOWEST + 1, np.int64), same=False, k=plan.negatives)
    links = index.sparkSession.sparkContext.broadcast((own["id"], ids, scores))

    def name(batches):
        anchor_ids, positive_ids, positive_scores = links.value
        for b in batches:
            a, w = b.column(0).to_numpy(), b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor_ids[a]), pa.array(positive_ids[a, w]), b.column(4), b.column(3), pa.array(positive_scores[a, w]), b.column(2)],
                ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return _windows(index, request, pivots, radii, square).mapInArrow(name, RESULT)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(df: DataFrame, is_anchor: Column, id: str = "vec_id", label: Column | str = "label", vector: str = "embedding",
                   times: int = 256, plan: Plan = Plan()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``is_anchor`` is an expression of ``id``."""
    spark = df.sparkSession
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows = materialise(usable_rows(df, id, label, vector, times))
    sizes = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square")) \
        .orderBy(F.desc("n"), F.desc("width")).head(1)
    if not sizes:
        return spark.createDataFrame([], RESULT)
    width, n, square = sizes[0]["width"], sizes[0]["n"], max(float(sizes[0]["square"]), 1.0)
    index, pivots, radii = build_index(rows.where(F.size("v") == width), width, n, square)
    anchors = index.where(is_anchor).select("id", "label", "pivot", "v")
    batches, most = 1, anchors.count()
    place = F.xxhash64("id", "label", "v")
    while most > BATCH:
        batches *= 2
        most = anchors.groupBy(F.pmod(place, F.lit(batches)).alias("b")).count().agg(F.max("count").alias("n")).first()["n"]
    results = []
    for b in range(batches):
        own = anchors.where(F.pmod(place, F.lit(batches)) == b).toArrow()
        if len(own):
            result = _of_batch(index, own, pivots, radii, square, plan)
            results.append(result if batches == 1 else materialise(result))
    drop_copy(rows)
    out = spark.createDataFrame([], RESULT)
    for result in results:
        out = result if len(results) == 1 else out.unionByName(result)
    return out
