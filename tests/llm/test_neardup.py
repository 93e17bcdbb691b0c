from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_components import brute_components

from tabwright.llm.neardup import BLOCK, Banding, near_duplicates, one_of_each
from tabwright.llm.tokens import BLOCK as BYTES
from tabwright.llm.tokens import word_hashes


def brute(rows, percent=85):
    sets = {}
    for id, text in rows:
        words = (text or "").encode().lower().split()
        own = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        sets[id] = own
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    component = dict(brute_components(edges))
    return {(id, len(own), component.get(id, id), component.get(id, id) == id) for id, own in sets.items()}


def family(seed, copies, words, edits):
    """A text and copies with single words replaced, and copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = [base]
    for _ in range(copies):
        own = list(rng.choice(texts))
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        texts.append(own)
    return [" ".join(t) for t in texts]


@pytest.fixture(scope="module")
def rows():
    texts = [t for k in range(6) for t in family(k, 25, 150, 3)] + family(99, 60, 60, 1)
    texts += [texts[0]] * 30 + [texts[0].upper(), None, "", " \t\n", "one two", "One  two", "two one", "a b c d e"]
    texts += [" ".join(f"v{k}" for k in range(30_000)), " ".join(f"v{k}" for k in range(29_000))]
    random.Random(5).shuffle(texts)
    return list(enumerate(texts))


def test_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = near_duplicates(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = found.collect()
    assert len(found) == len(rows) and {tuple(r) for r in found} == brute(rows)


def test_blocks_do_not_change_components(spark, rows, monkeypatch):
    monkeypatch.setattr("tabwright.llm.neardup.BLOCK", 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in near_duplicates(docs).collect()} == brute(rows)
    assert BLOCK > 500


def test_lower_similarity(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs, plan=Banding(percent=80, agree=0.65)).collect()
    assert {tuple(r) for r in found} == brute(rows, 80)


def test_odd_rows(spark):
    long_ = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame(
        [(None, long_, "x"), (3, long_, "x"), (3, long_, "x"), (2, long_ + " more", "y"), (7, None, None), (8, "", "z")],
        "doc_id long, text string, component_id string")
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert found == sorted([(None, None, True), (3, 2, False), (3, 2, False), (2, 2, True), (7, 7, True), (8, 8, True)], key=str)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == ["2", "7", "8", "None"]


def test_one_of_each_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g")] * 4 + [(2, "other words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in one_of_each(docs).collect()) == [1, 2]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).collect() == [] and one_of_each(docs).collect() == []


def test_word_hashes_across_blocks():
    rng = random.Random(1)
    for size in (10, BYTES - 1, BYTES, 3 * BYTES):
        text = bytes(rng.choice(b"abZ \n\t") for _ in range(size)) + b"q" * BYTES * 2 + b" \x0b" + b"z" * 9
        words = text.lower().split()
        found = word_hashes(text, lower=True)
        assert len(found) == len(words)
        assert len(set(found.tolist())) == len(set(words))
        assert found[:50].tolist() == [word_hashes(w)[0] for w in words[:50]]
