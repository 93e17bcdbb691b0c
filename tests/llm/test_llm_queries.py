"""Registered queries against SQL, and the pipeline against its stages' rules."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_point  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle import connect, difference  # noqa: E402

from tabwright.llm.queries import ORACLES, QUERIES  # noqa: E402
from tabwright.sources.durable import materialise  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), connect(small), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs_on_whole_tables(spark, small, name):
    rows = QUERIES[name](spark, small)
    assert len(set(rows.columns)) == len(rows.columns)
    n = {t: spark.read.parquet(f"{small}/{t}.parquet").count() for t in ("documents", "pages", "conversations")}
    got = rows.count()
    if name.startswith(("op3",)):
        assert got == n["pages"]
    if name.startswith(("op4", "op5", "op10")):
        assert got == n["documents"]
    if name.startswith("op6"):
        assert got == n["conversations"]


def test_all_operators_and_the_pipeline_are_registered():
    names = entry_point.queries()
    assert all(any(q.startswith(f"op{k}_") for q in names) for k in range(1, 14)) and "pipeline" in names


def stages(spark, docs, folder):
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialise(stage(spark, frames[-1], folder)))
    return frames


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    frames = stages(spark, docs, small)
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert ids[0] > ids[1] > ids[2] > ids[3] == ids[4] == ids[5]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert not {i for i in ids[3] if labels.get(i) == 0 and i not in ids[1]}
    text = {r.doc_id: r.text for r in frames[4].collect()}
    assert sum(r.length for r in frames[5].collect()) == sum(len(t.encode().split()) for t in text.values())
    run = corpus_pipeline.run(spark, small)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, frames[5].collect()))


def test_pipeline_with_odd_tables(spark, tmp_path):
    words = "the quick brown fox jumps over a lazy dog and runs home again to sleep near its warm old fire tonight"
    rows = [(1, words, "en", "s", 5, "x"), (1, words, "en", "s", 5, "x"), (2, words, "en", "s", 5, None), (None, words, None, None, None, "y"),
            (3, None, "en", "s", None, "z"), (4, "", "en", "s", 0, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, verdict string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == ["1", "None"]
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, str(tmp_path))
        assert out.columns == empty.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, empty, str(tmp_path)).collect() == []
