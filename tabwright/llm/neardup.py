"""Near-duplicate documents: minima of many universal hashes, banding, checks on full sets, components.

Documents with equal shingle sets are one node, named by their smallest id, so a group of copies of any
size is a single node from the first shuffle on. Each node has ``bands * rows`` minima. Nodes with
equal minima in a band share a bucket. Links are found in two steps:

* every node of a bucket is compared with the bucket's hub (the node that shares most buckets): they must
  agree in enough minima, then pass the exact test on both full sets;
* nodes that met under the same hub and are not yet one component are compared with each other, in
  blocks: all nodes outside the largest component with all nodes of other components, by minima and
  then on full sets. A task joins components as it finds links and returns only the links that did, since
  others could not change the components. Its rows are bounded by a number of shingles.

Two nodes that share a bucket have met its hub, so every pair that shares a bucket and is not already
connected is compared. Components come from large-star and small-star steps.

With 25 bands of 5 minima, a pair at a similarity of 0.85 shares no bucket with a chance of 4e-7, and
it agrees in fewer than 70 % of 125 minima with a chance of 2e-6.

Defined results: documents without words (null or empty text) have no shingles and are linked with
nothing. Rows without an id are linked with nothing, have no component and are kept. Rows that share
an id are one document, linked by each of its texts. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tabwright.llm.components import connected_components
from tabwright.llm.tokens import free_name, shingle_hashes, word_hashes
from tabwright.sources.durable import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BROADCAST_IDS = 1_000_000  # most ids in a broadcast; beyond it the texts are shuffled to meet them
BLOCK = 200_000  # shingles on either side of a block of comparisons
SEED = 9
SetsOf = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Banding:
    """``percent``: least 100 * intersection / union of a link; ``agree``: least share of equal minima."""

    shingle: int = 5
    percent: int = 85
    bands: int = 25
    rows: int = 5
    agree: float = 0.7


def hash_family(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of multiply-add-shift, which is universal on 32-bit values."""
    return tuple(np.random.default_rng(SEED).integers(0, 1 << 64, (2, size), dtype=np.uint64))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash over all shingles, as uint32; memory is bounded by slices."""
    x = (shingles >> np.uint64(32))[:, None]
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 1024):
        values = x[at: at + 1024] * a
        values += b
        np.minimum(least, values.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text, lower=True), size))


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def set_profile(text: Column, plan: Banding) -> Column:
    """struct(n_shingles, digest of the set, minima); digest and minima are null without shingles."""
    a, b = hash_family(plan.bands * plan.rows)

    @F.arrow_udf("n_shingles long, digest binary, minima binary")
    def profile(texts: pa.Array) -> pa.Array:
        sizes, digests, signatures = [], [], []
        for value in _texts(texts):
            own = shingle_set(value, plan.shingle)
            sizes.append(len(own))
            digests.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            signatures.append(minima(own, a, b).tobytes() if len(own) else None)
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            names=["n_shingles", "digest", "minima"])

    return profile.asNondeterministic()(text.cast("string"))  # once a text, wherever the fields are used


def _full_sets(text: Column, plan: Banding) -> Column:
    @F.arrow_udf("array<long>")
    def full_set(texts: pa.Array) -> pa.Array:
        sets = [shingle_set(value, plan.shingle) for value in _texts(texts)]
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))

    return full_set.asNondeterministic()(text.cast("string"))


@F.arrow_udf(DoubleType())
def agreement(left: pa.Array, right: pa.Array) -> pa.Array:
    """Share of equal minima."""
    def matrix(column):
        values = column.to_pylist()
        return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), -1)
    if not len(left):
        return pa.array([], pa.float64())
    return pa.array((matrix(left) == matrix(right)).mean(axis=1))


def _sizes_allow(n: str, m: str, percent: int) -> Column:
    """True where a size is not known."""
    return F.coalesce(F.least(n, m) * 100 >= F.greatest(n, m) * percent, F.lit(True)) | F.col(n).isNull() | F.col(m).isNull()


def _similar(pairs: DataFrame, nodes: DataFrame, plan: Banding) -> DataFrame:
    """Pairs (a, b) whose set sizes and minima allow a link."""
    own = nodes.select("node", "n_shingles", "minima")
    left = own.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("minima").alias("m_a"))
    right = own.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("minima").alias("m_b"))
    return pairs.join(left, "a").join(right, "b").where(_sizes_allow("n_a", "n_b", plan.percent)) \
        .where(agreement("m_a", "m_b") >= plan.agree).select("a", "b").distinct()


def bounded(rows: DataFrame) -> DataFrame:
    """Marked for a broadcast if they are few enough; else the join shuffles both sides."""
    return F.broadcast(rows) if rows.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else rows


def _confirmed(pairs: DataFrame, sets_of: SetsOf, plan: Banding) -> DataFrame:
    """Pairs (a, b) that pass the exact test on the full sets of both, out of stored pairs."""
    sets = materialise(sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()))
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    # the hub of many pairs is on the side that streams past its one set
    return pairs.join(left, "a").join(right, "b").withColumn("both", both) \
        .where(F.col("both") * 100 >= (F.size("of_a") + F.size("of_b") - F.col("both")) * plan.percent) \
        .select("a", "b").distinct()


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """Each node (a) with the hub (b) of each of its buckets: the node that meets most nodes over all buckets."""
    sizes = shared.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    met = shared.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("met"))
    ranked = shared.join(met, "node")
    hubs = ranked.groupBy("bucket").agg(F.max("met").alias("met")).join(ranked, ["bucket", "met"]) \
        .groupBy("bucket").agg(F.min("node").alias("hub"))
    return shared.join(hubs, "bucket").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def _minima_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["minima"].to_pylist()), np.uint32).reshape(len(table), -1)


def _sets_of(table: pa.Table) -> list[np.ndarray]:
    items = table["items"].combine_chunks()
    items = items if isinstance(items, pa.Array) else pa.concat_arrays(items.chunks)
    ends, values = items.offsets.to_numpy(), items.values.to_numpy()
    return [values[i:j] for i, j in zip(ends, ends[1:])]


def _joining_links(plan: Banding):
    def compare(outside: pa.Table, everyone: pa.Table) -> pa.Table:
        """Links between nodes of different components, as long as they join components of this block."""
        if not len(outside) or not len(everyone):  # a block may have rows of one side only
            return pa.table({c: pa.array([], outside.schema.field("node").type) for c in ("a", "b")})
        mine, all_ = _minima_of(outside), _minima_of(everyone)
        my_sets, sets = _sets_of(outside), _sets_of(everyone)
        sizes = np.array([len(x) for x in sets])
        names, nodes = outside["node"].to_pylist(), everyone["node"].to_pylist()
        turn = np.array([not out for out in everyone["outside"].to_pylist()])
        codes = np.unique(everyone["label"].to_pylist() + outside["label"].to_pylist(), return_inverse=True)[1]
        labels, my_labels, found = codes[:len(nodes)], codes[len(nodes):], []
        for i, (name, own) in enumerate(zip(names, my_sets)):
            n = len(own)
            # two outside nodes meet twice, each in turn; one of the two times will do
            fits = (labels != my_labels[i]) & (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * plan.percent) \
                & (turn | np.array([name < other for other in nodes]))
            fits[fits] = (all_[fits] == mine[i]).mean(axis=1) >= plan.agree
            places = np.flatnonzero(fits)
            if not len(places):
                continue
            values = np.concatenate([sets[k] for k in places])
            hit = own[np.minimum(np.searchsorted(own, values), n - 1)] == values
            both = np.add.reduceat(hit.astype(np.int64), np.r_[0, np.cumsum(sizes[places])[:-1]])
            for k in places[both * 100 >= (n + sizes[places] - both) * plan.percent]:
                if labels[k] != my_labels[i]:
                    found.append((name, nodes[k]))
                    old = labels[k]
                    labels[labels == old] = my_labels[i]
                    my_labels[my_labels == old] = my_labels[i]
        kind = outside["node"].type
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})
    return compare


def _remaining_links(met: DataFrame, nodes: DataFrame, labels: DataFrame, sets_of: SetsOf, plan: Banding) -> DataFrame | None:
    """Links that join components among the nodes (a) that met the same hub (b); None if all are in one piece."""
    told = met.select(F.col("b").alias("hub"), F.col("a").alias("node")).join(labels, "node", "left") \
        .withColumn("label", F.coalesce("component", "node")).drop("component") \
        .join(nodes.select("node", "n_shingles", "minima"), "node")
    pieces = told.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("n_shingles", F.lit(32))).alias("mass"))
    main = pieces.groupBy("hub").agg(
        F.count(F.lit(1)).alias("pieces"), F.sum("mass").alias("total"), F.max("n").alias("n")).where("pieces > 1") \
        .join(pieces, ["hub", "n"]).groupBy("hub", "total").agg(F.min(F.struct("label", "mass")).alias("main"))
    open_ = materialise(told.join(main, "hub").select(
        "hub", "node", "label", "minima", (F.col("label") != F.col("main.label")).alias("outside"),
        F.ceil((F.col("total") - F.col("main.mass")) / BLOCK).cast("int").alias("rows"),
        F.ceil(F.col("total") / BLOCK).cast("int").alias("columns")))
    if not open_.limit(1).count():
        return None
    sets = materialise(sets_of(open_.select(F.col("node").alias("id")).distinct()))
    # sets come sorted by unsigned value and are searched as signed ones
    open_ = open_.join(sets.select(F.col("id").alias("node"), F.array_sort("items").alias("items")), "node")
    place = F.xxhash64("node")
    everyone = open_.withColumn("column", F.pmod(place, "columns").cast("int")) \
        .withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    outside = open_.where("outside").withColumn("row", F.pmod(place, "rows").cast("int")) \
        .withColumn("column", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)))
    keys, kept = ["hub", "row", "column"], ["node", "label", "minima", "items", "outside"]
    id_type = nodes.schema["node"].dataType.simpleString()
    everyone = everyone.select(*[F.col(c).alias(c) for c in keys + kept])  # columns of its own, as Spark asks for
    return outside.select(*keys, *kept).groupBy(*keys).cogroup(everyone.groupBy(*keys)) \
        .applyInArrow(_joining_links(plan), f"a {id_type}, b {id_type}").distinct()


def linked_components(nodes: DataFrame, sets_of: SetsOf, plan: Banding) -> DataFrame:
    """(node, component) of the linked ones of stored nodes (node, n_shingles or null, minima).

    ``sets_of`` takes a frame of distinct (id) and gives (id, items), the full shingle set of each node.
    """
    width = F.lit(4 * plan.rows)
    bands = F.explode(F.transform(F.sequence(F.lit(0), F.lit(plan.bands - 1)), lambda k: F.struct(
        k.alias("band"), F.xxhash64(k, F.substring("minima", k * (4 * plan.rows) + 1, width)).alias("bucket"))))
    banded = nodes.select("node", bands.alias("x")).select("node", "x.bucket").distinct()
    full = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    met = materialise(_hub_pairs(materialise(banded.join(full, "bucket"))))
    links = materialise(_confirmed(materialise(_similar(met, nodes, plan)), sets_of, plan))
    labels = connected_components(links)
    more = _remaining_links(met, nodes, labels, sets_of, plan)
    if more is not None:
        more = materialise(more)
        if more.limit(1).count():
            labels = connected_components(links.union(more))
    return labels


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", plan: Banding = Banding()) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, kept).

    ``component_id`` is the smallest id that links lead to; ``kept`` marks the document of that id.
    """
    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    profile = materialise(named.select("id", set_profile(F.col("text"), plan).alias("p")).select("id", "p.*"))
    nodes = materialise(profile.where("id IS NOT NULL AND digest IS NOT NULL").groupBy("digest", "n_shingles", "minima")
                        .agg(F.min("id").alias("node")))

    def sets_of(wanted: DataFrame) -> DataFrame:
        return named.join(bounded(wanted), "id", "left_semi").select("id", _full_sets(F.col("text"), plan).alias("items"))

    labels = linked_components(nodes, sets_of, plan)
    named_nodes = nodes.select("digest", "node").join(labels, "node", "left") \
        .select("digest", F.coalesce("component", "node").alias("component"))
    return profile.join(named_nodes, "digest", "left").select(
        F.col("id").alias(id), "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(f"`{id}`") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", plan: Banding = Banding()) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, one row of each id; rows without an id all stay."""
    verdict = materialise(near_duplicates(docs, id, text, plan).select(F.col(f"`{id}`").alias("id__"), "kept"))
    gone = bounded(verdict.where(~F.col("kept")).select("id__").distinct())
    left = docs.join(gone, F.col(f"`{id}`") == F.col("id__"), "left_anti")
    again = verdict.where("kept AND id__ IS NOT NULL").groupBy("id__").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id__")
    if not again.limit(1).count():
        return left
    again = bounded(again)
    place, order = free_name(docs, "place"), [F.xxhash64(F.col(f"`{c}`").cast("string")) for c in docs.columns]
    first = left.join(again, F.col(f"`{id}`") == F.col("id__"), "left_semi").withColumn(
        place, F.row_number().over(Window.partitionBy(F.col(f"`{id}`")).orderBy(F.col(f"`{text}`"), *order))) \
        .where(F.col(place) == 1).drop(place)
    return left.join(again, F.col(f"`{id}`") == F.col("id__"), "left_anti").unionByName(first)
