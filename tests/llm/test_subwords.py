from __future__ import annotations

import re
import zlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import subwords as s
from tabwright.llm.tokens import word_hashes

QUICK = s.Training(steps=2500)


def test_features_equal_plain_ones():
    text = "The  the cat\n sat, é"
    words = re.findall(r"[^ \t-\r]+", text)
    spaced = f" {' '.join(words)} "
    runs = [spaced[k:k + n] for n in (3, 4, 5) for k in range(len(spaced) - n + 1) if " " not in spaced[k + 1:k + n - 1]]
    found = s.features(text, 1 << 30)
    assert len(found) == len(words) + len(words) - 1 + len(runs)
    alike = {r: set() for r in runs}
    for r, f in zip(runs, found[2 * len(words) - 1:]):
        alike[r].add(f)
    assert all(len(x) == 1 for x in alike.values()) and len({min(x) for x in alike.values()}) == len(alike)
    assert found[:len(words)].tolist() == (word_hashes(text.encode()) % np.uint64(1 << 30)).astype(int).tolist()
    assert len(s.features("", 8)) == len(s.features("  ", 8)) == 0


def test_step_follows_the_gradient():
    training = s.Training(buckets=64, size=4, steps=1, rate=0.1)
    start = s.learn(["a b c"], [1], replace(training, steps=0))
    after = s.learn(["a b c"], [1], training)
    assert start.bias == 0 and after.score("a b c") > start.score("a b c") == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = s.train(docs, labels, training=s.Training(steps=6000))
    rows = docs.join(labels, "doc_id").where(s.held_out(F.col("doc_id"))) \
        .select("doc_id", "quality", s.score(F.col("text"), model).alias("score")).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 500
    right = sum((r.score >= 0.3) == bool(r.quality) for r in rows)
    assert right >= 0.98 * len(rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "good words here"), (2, "bad ### %%%"), (3, None), (4, ""), (None, "good words"), (1, "good words here"), (6, "x" * 2_000_000)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    model = s.train(docs, labels, training=QUICK)
    rows = {(r.doc_id, r.n): r.score for r in docs.select("doc_id", F.length("text").alias("n"), s.score(F.col("text"), model).alias("score")).collect()}
    assert len(rows) == 6 and all(0 <= x <= 1 for x in rows.values()) and rows[3, None] == rows[4, 0]
    none = s.train(docs, labels.limit(0), training=QUICK)
    assert {r[0] for r in docs.select(s.score(F.col("text"), none)).collect()} == {0.5}
    assert docs.limit(0).select(s.score(F.col("text"), model)).collect() == []
