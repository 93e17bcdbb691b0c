from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tabwright.llm.contamination import Budget, Finder, Pattern, cut_pieces, with_hits, words_of


def plain_best(item, text):
    """Least edit distance of the item to any run of the text's words, by the usual table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[at:at + (kind != 0)] = [] if kind == 1 else [f"z{rng.randrange(99)}"]
    return words


@pytest.mark.parametrize("seed", range(8))
def test_myers_equals_the_table(seed):
    rng = random.Random(seed)
    for _ in range(60):
        item = [rng.choice("abcd") for _ in range(rng.randrange(1, 90))]
        text = [rng.choice("abcd") for _ in range(rng.randrange(120))]
        best, end = Pattern(item).best(text)
        assert best == plain_best(item, text) and best == plain_best(item, text[:end])


def test_pieces():
    words = [str(k) for k in range(23)]
    pieces = cut_pieces(words, 5)
    assert [w for _, piece in pieces for w in piece] == words and all(words[at] == piece[0] for at, piece in pieces)


def test_finds_all_within_budget(spark):
    rng = random.Random(1)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randrange(8, 60))] for _ in range(25)] + [["too", "short"], []]
    texts = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 200))]
        if k % 2:
            item = rng.choice(items[:25])
            at = rng.randrange(len(words))
            words[at:at] = edited(rng, item, rng.randrange(int(0.35 * len(item)) + 1))
        texts.append(", ".join(words).title())
    texts += ["far too short for edits", "too long, short", None, "", " ", "w1 " * 50_000 + " ".join(items[3]), texts[1]]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, hits string")
    table = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(99, None)], "item_id long, text string")
    found = with_hits(docs, table)
    assert found.columns == ["doc_id", "text", "hits", "hits_"]
    got = {(r.doc_id, h.item): h.distance for r in found.collect() for h in r.hits_}
    want = {}
    for k, text in enumerate(texts):
        words = words_of(text or "")
        for number, item in enumerate(items):
            if item and len(words) < 1000:
                distance = plain_best(item, words)
                if distance <= (int(0.2 * len(item)) if len(item) >= 8 else 0):
                    want[k, number] = distance
    long_ = len(texts) - 2
    assert got.pop((long_, 3)) == 0
    assert got == want and len(want) > 30


def test_blocks_of_items_find_the_same(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    whole = {(r.doc_id, h.item, h.distance) for r in with_hits(docs, items).collect() for h in r.hits}
    monkeypatch.setattr("tabwright.llm.contamination.BLOCK_CHARS", 2000)
    assert {(r.doc_id, h.item, h.distance) for r in with_hits(docs, items).collect() for h in r.hits} == whole != set()


def test_empty_tables_and_other_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id int, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.hits for r in with_hits(docs, none).collect()] == [[]]
    assert with_hits(docs.limit(0), none).collect() == []
    named = spark.createDataFrame([("q", "A b c, d e f g h")], "item_id string, text string")
    assert [h.item for r in with_hits(docs, named).collect() for h in r.hits] == ["q"]
    assert Finder(["a b c", "", None, "?!"], Budget()).find("x a b c") == [(0, 0, 4)]
    assert with_hits(docs, named).where(F.size("hits") == 0).count() == 0


def test_short_items_are_found_word_for_word(spark):
    docs = spark.createDataFrame([
        (1, "Quiz: What is the capital of France? Paris."), (2, "What is the capital city of France?"), (3, "the capital of"),
        (4, "paris, in spring"), (5, "comparison")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "what is the capital of france"), (2, "Paris"), (3, "the capital of"), (4, " ")], "item_id long, text string")
    found = {(r.doc_id, h.item, h.distance, h.ends) for r in with_hits(docs, items).collect() for h in r.hits}
    assert found == {(1, 1, 0, 7), (1, 2, 0, 8), (1, 3, 0, 6), (3, 3, 0, 3), (4, 2, 0, 1)}
