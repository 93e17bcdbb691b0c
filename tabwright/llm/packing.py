"""Best-fit packing of documents into bins, with conflicts.

A bin holds at most ``capacity`` units of length, at most one document of each source and at most one
of each cluster of duplicates. Longer documents are cut: full pieces fill bins of their own, and only
the rest is packed. Within a shard the rests go from the longest to the shortest. Bins are ordered by
(what is left, number); the search starts at the smallest one with enough room and goes on to its
successors until one has neither the source nor the cluster in its bitmap, so it finds the tightest
compatible bin; if there is none, a new bin is opened.

Shards have about ``shard`` documents by a hash of the document, whatever the size of the table, so no
task holds more than a bounded number of short rows (no texts), a source with a third of all rows is
spread over all shards, and a lost shard is packed again to the same bins.

``with_clusters`` names the clusters: near duplicates at five words and a similarity of 0.8 or more.

Defined results: a null length counts as 0; documents of length 0 get a piece of length 0; a null source or
cluster conflicts with nothing; rows that share an id are packed each on its own, and ``copy`` numbers rows
that are equal in id, length, source and cluster; null ids are packed too. An empty table gives no rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, insort
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.neardup import Banding, _full_sets as full_sets, bounded, hash_family, linked_components, minima
from tabwright.llm.tokens import shingle_hashes, word_hashes
from tabwright.sources.durable import drop_copy, materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 4096
NEAR = Banding(percent=80, agree=0.65)


def best_fit(items: list[tuple[int, object, object]], capacity: int) -> list[int]:
    """Bin of each item (length, source, cluster), taken in the order given; bins are numbered from 0."""
    bits: dict[tuple[str, object], int] = {}
    order: list[tuple[int, int]] = []  # (what is left, bin)
    taken: list[int] = []  # bitmap of sources and clusters per bin
    placed = []
    for length, source, cluster in items:
        mine = 0
        for kind, value in (("source", source), ("cluster", cluster)):
            if value is not None:
                mine |= 1 << bits.setdefault((kind, value), len(bits))
        at = bisect_left(order, (length, -1))
        while at < len(order) and taken[order[at][1]] & mine:
            at += 1
        if at < len(order):
            left, number = order.pop(at)
            taken[number] |= mine
        else:
            left, number = capacity, len(taken)
            taken.append(mine)
        insort(order, (left - length, number))
        placed.append(number)
    return placed


def _packed(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("rest", "descending"), ("tie", "ascending")]).to_pylist()
        packed = [r for r in rows if r["rest"] or not r["whole"]]  # what ends with a full piece has no rest
        bins = best_fit([(r["rest"], r["source"], r["cluster"]) for r in packed], capacity)
        used: dict[int, int] = {}
        out = []
        for row, number in zip(packed, bins):
            place = used.get(number, 0)
            used[number] = place + row["rest"]
            out.append((row, row["whole"], row["rest"], number, place))
        full = ((row, piece) for row in rows for piece in range(row["whole"]))
        out += [(row, piece, capacity, -1 - k, 0) for k, (row, piece) in enumerate(full)]
        columns = {"shard": pa.int64(), "id": table.schema.field("id").type, "copy": pa.int64()}
        return pa.table({
            **{c: pa.array([x[0][c] for x in out], kind) for c, kind in columns.items()},
            "piece": pa.array([x[1] for x in out], pa.int64()),
            "start": pa.array([x[1] * capacity for x in out], pa.int64()),
            "length": pa.array([x[2] for x in out], pa.int64()),
            "bin": pa.array([x[3] for x in out], pa.int64()),
            "place": pa.array([x[4] for x in out], pa.int64()),
        })
    return pack


def pack(docs: DataFrame, length: Column, source: Column, cluster: Column, id: str = "doc_id", capacity: int = 2048,
         shard: int = SHARD) -> DataFrame:
    """One row per piece of a stored table: (id, copy, piece, start, length, shard, bin, place).

    ``bin`` is unique within its ``shard``; ``place`` is where the piece starts in the bin. A document's
    pieces follow each other from ``start`` 0 on; those that fill a bin have bins of their own, below 0.
    """
    own = docs.select(F.col(f"`{id}`").alias("id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("n"),
                      source.cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    # rows that are equal in all of this are counted, then numbered, so that they spread over the shards
    rows = own.groupBy("id", "n", "source", "cluster").agg(F.count(F.lit(1)).alias("times")) \
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    tie = F.xxhash64("id", "n", "source", "cluster", "copy")
    count = max(1, round(docs.count() / shard))
    rests = rows.select(
        F.pmod(tie, F.lit(count)).alias("shard"), "id", "copy", tie.alias("tie"), "source", "cluster",
        F.expr(f"n div {int(capacity)}").alias("whole"), (F.col("n") % capacity).alias("rest"))
    kind = rests.schema["id"].dataType.simpleString()
    return rests.groupBy("shard").applyInArrow(
        _packed(capacity),
        f"shard long, id {kind}, copy long, piece long, start long, length long, bin long, place long",
    ).select(F.col("id").alias(id), "copy", "piece", "start", "length", "shard", "bin", "place")


def copy_key(text: Column) -> Column:
    """Cluster of a text: texts that are equal but for letter case and blanks; none for a text without words."""
    words = F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))
    return F.when(F.length(words) > 0, F.md5(words))


def text_facts(text: Column, plan: Banding) -> Column:
    """struct(n_words, n_shingles, digest of the shingle set, minima) from one pass over a text."""
    a, b = hash_family(plan.bands * plan.rows)

    @F.arrow_udf("n_words long, n_shingles long, digest binary, minima binary")
    def facts(texts: pa.Array) -> pa.Array:
        words, sizes, digests, signatures = [], [], [], []
        for value in texts.cast(pa.binary()).to_pylist():
            hashes = word_hashes(value or b"", lower=True)
            own = np.unique(shingle_hashes(hashes, plan.shingle))
            words.append(len(hashes))
            sizes.append(len(own))
            digests.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            signatures.append(minima(own, a, b).tobytes() if len(own) else None)
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            names=["n_words", "n_shingles", "digest", "minima"])

    return facts.asNondeterministic()(text.cast("string"))


def with_clusters(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A stored table (id, n_words, source, cluster); near duplicates have one cluster, named by the smallest id.

    Texts with equal shingle sets have one cluster, also in rows without an id; those without words have none.
    """
    named = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source"))
    own = materialise(named.select("id", "source", text_facts(F.col("text"), NEAR).alias("f")).select("id", "source", "f.*"))
    nodes = materialise(own.where("id IS NOT NULL AND digest IS NOT NULL").groupBy("digest", "n_shingles", "minima")
                        .agg(F.min("id").alias("node")))

    def sets_of(wanted: DataFrame) -> DataFrame:
        return named.join(bounded(wanted), "id", "left_semi").select("id", full_sets(F.col("text"), NEAR).alias("items"))

    labels = linked_components(nodes, sets_of, NEAR)
    clusters = nodes.select("digest", "node").join(labels, "node", "left") \
        .select("digest", F.coalesce("component", "node").cast("string").alias("component"))
    cluster = F.coalesce(F.col("component"), F.hex("digest"))
    out = materialise(own.join(clusters, "digest", "left").select(
        F.col("id").alias(id), "n_words", F.col("source").alias(source), cluster.alias("cluster")))
    drop_copy(own)
    drop_copy(nodes)
    return out


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"[^ \t-\r]+"), F.lit(0)))
