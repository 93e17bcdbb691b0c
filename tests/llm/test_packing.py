from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tabwright.llm.packing import best_fit, copy_key, n_words, pack, with_clusters
from tabwright.llm.queries import QUERIES


def brute(items, capacity):
    """The tightest compatible bin by looking at all of them; of equal ones the first opened."""
    bins, placed = [], []
    for length, source, cluster in items:
        fits = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= length
                and (source is None or source not in b["sources"]) and (cluster is None or cluster not in b["clusters"])]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append({"left": capacity, "sources": set(), "clusters": set()})
        bins[k]["left"] -= length
        bins[k]["sources"].add(source)
        bins[k]["clusters"].add(cluster)
        placed.append(k)
    return placed


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_looking_at_all_bins(seed):
    rng = random.Random(seed)
    items = [(rng.randrange(60), rng.choice(["hot", "hot", None, *"abcdef"]), rng.choice([None, *range(40)])) for _ in range(400)]
    assert best_fit(items, 100) == brute(items, 100)


def check(rows, docs, capacity):
    """All pieces are there, bins hold their capacity, and no bin has a conflict."""
    bins = {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: (r.place, r.length))
        assert sum(r.length for r in own) <= capacity
        assert all(a.place + a.length == b.place for a, b in zip(own, own[1:])) and own[0].place == 0
        if len(own) > 1:
            for field in (1, 2):
                values = [docs[r.doc_id][field] for r in own if docs[r.doc_id][field] is not None]
                assert len(values) == len(set(values))
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.copy), []).append((r.start, r.length))
    for (doc, _), own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == (docs[doc][0] or 0)
    return len(pieces)


def test_pack(spark):
    rng = random.Random(3)
    docs = {k: (rng.choice([None, 0, 5, 100, 99, 250, 300, rng.randrange(100)]), rng.choice(["hot", None, "a", "b", "c"]),
                rng.choice([None, *range(20)])) for k in range(500)}
    table = spark.createDataFrame([(k, *v, "clash") for k, v in docs.items()], "doc_id long, n long, source string, cluster int, bin string")
    args = (F.col("n"), F.col("source"), F.col("cluster"))
    rows = pack(table, *args, capacity=100, shard=100).collect()
    assert check(rows, docs, 100) == 500
    again = pack(table.repartition(7), *args, capacity=100, shard=100).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert len({r.shard for r in rows}) == 5


def test_odd_rows(spark):
    table = spark.createDataFrame([(None, "a b", "s"), (1, None, None), (1, "x " * 10, "s"), (1, "x " * 10, "s")],
                                  "doc_id long, text string, source string")
    rows = pack(table, n_words(F.col("text")), F.col("source"), copy_key(F.col("text")), capacity=8).collect()
    assert sum(r.length for r in rows) == 22 and sum(r.doc_id is None for r in rows) == 1
    assert {r.copy for r in rows if r.length == 8} == {0, 1}
    assert pack(table.limit(0), n_words(F.col("text")), F.col("source"), copy_key(F.col("text"))).collect() == []


def test_copy_key(spark):
    texts = ["One two", "one\n TWO ", "one", None, "", " \n"]
    keys = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "i int, t string").orderBy("i")
            .select(copy_key(F.col("t"))).collect()]
    assert keys[0] == keys[1] != keys[2] and keys[3:] == [None] * 3


def test_near_duplicates_share_no_bin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clusters = {r.doc_id: r.cluster for r in with_clusters(docs).collect()}
    near = [(255, 278), (255, 773), (255, 830), (255, 991), (2, 56), (709, 944)]
    assert all(clusters[a] == clusters[b] for a, b in near) and len(set(clusters.values())) > 500
    bins = {}
    for r in QUERIES["op1_best_fit_packing"](spark, "/root/testdata/sf0.01").collect():
        bins.setdefault((r.shard, r.bin), []).append(clusters[r.doc_id])
    for own in bins.values():
        own = [c for c in own if c is not None]
        assert len(own) == len(set(own))


def test_clusters_of_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text), (4, text.upper()), (4, text), (7, text.replace("w59", "x")), (8, " "), (None, "other"), (9, None)]
    table = with_clusters(spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string"))
    found = sorted(((r.doc_id, r.cluster) for r in table.collect()), key=str)
    assert [c for k, c in found if k in (4, 7)] == ["4"] * 3 and [c for k, c in found if k in (8, 9)] == [None] * 2
    assert len(found) == 7 and sum(c == "4" for k, c in found if k is None) == 1
