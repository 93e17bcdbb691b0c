"""Encoding and decoding against the tokenizers library, merges and joins against each other."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tabwright.llm import bpe  # noqa: E402
from tabwright.llm.queries import QUERIES  # noqa: E402

SOURCE = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
VOCABULARY = bpe.Vocabulary(SOURCE)
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def library(text: str) -> list[int]:
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own(text: str) -> list[int]:
    known = bpe.Known(VOCABULARY)
    return np.frombuffer(b"".join([known[p] for some in bpe.parts(text) for p in some]), np.int32).tolist()


def odd_texts(n: int) -> list[str]:
    rng = random.Random(5)
    alphabets = ["abcdefgh", "aaaa ", " \n\t" + chr(0x3000) + chr(0xA0) + chr(0x1C) + chr(0x85), "0123456789", "!?.,'",
                 "".join(map(chr, [0xE9, 0xFC, 0x4E2D, 0x6587, 0x1F600, 0x558, 0xA7CE])), "'" + chr(0x2019)]
    extra = ["<|endoftext|>", "'s", "'ll ", " don't", "  <|endoftext|>  ", "'S"]
    out = []
    for _ in range(n):
        text = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 120)))
        at = rng.randint(0, len(text))
        out.append(text[:at] + (rng.choice(extra) if rng.random() < 0.3 else "") + text[at:])
    return out


@pytest.mark.parametrize("slice_", [20, 1 << 20])
def test_odd_texts_equal_the_library(slice_, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", slice_)
    for text in odd_texts(1500):
        ids = library(text)
        assert own(text) == ids, text
        assert VOCABULARY.spelled(ids).decode("utf-8", "replace") == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_character_equals_the_library():
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)}! " for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert own(text) == library(text), hex(start)


@pytest.mark.parametrize("leaf", [2, 7, 16, 64])
def test_joined_halves_equal_the_whole(leaf):
    rng = random.Random(leaf)
    for n in range(400):
        base = "".join(rng.choices("abcdetnorsi", k=rng.randint(1, 20)))
        text = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 300))), base * 30, rng.choice("a-=_ ") * rng.randint(1, 400)][n % 3]
        data = text.encode()
        assert b"".join(bpe.halves(data, leaf)) == data and max(map(len, bpe.halves(data, leaf))) <= leaf
        assert VOCABULARY.tree([VOCABULARY.merged(x) for x in bpe.halves(data, leaf)]) == VOCABULARY.merged(data)


def test_window_grows_until_both_sides_agree(monkeypatch):
    seen = []
    merged = bpe.Vocabulary.merged
    monkeypatch.setattr(bpe.Vocabulary, "merged", lambda self, data: seen.append(len(data)) or merged(self, data))
    left, right = merged(VOCABULARY, b"a" * 2001), merged(VOCABULARY, b"a" * 1003)
    assert VOCABULARY.joined(left, right) == merged(VOCABULARY, b"a" * 3004)
    assert len(seen) > 1 and seen == sorted(seen)


def rows_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_long_runs_go_through_the_tree(spark):
    rng = random.Random(2)
    run = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=50_000))
    texts = [f"before {run} between {run[:9000]}<|endoftext|>{run[7:30000]}!", " " * 20_000 + "x", "-" * 10_001, chr(0x4E2D) * 30_000, "short",
             run + "1" * 5000 + " end " + "\n \t" * 6000, run, run]
    df = bpe.decode(bpe.encode(rows_of(spark, texts), SOURCE), SOURCE)
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(texts) and df.columns == ["doc_id", "text", "ids", "decoded"]
    for k, text in enumerate(texts):
        assert got[k].ids == library(text) and got[k].decoded == text


def test_odd_rows(spark):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "one two", None), (None, "one two", 3)]
    df = bpe.encode(spark.createDataFrame(rows, "doc_id long, text string, ids int"), SOURCE)
    assert df.columns == ["doc_id", "text", "ids", "ids_"] and df.schema["ids_"].dataType.simpleString() == "array<int>"
    assert sorted((str(r.doc_id), r.ids_) for r in df.collect()) == [
        ("1", []), ("1", []), ("2", library("one two")), ("None", []), ("None", library("one two"))]
    assert bpe.decode(bpe.encode(rows_of(spark, []), SOURCE), SOURCE).collect() == []
    odd = spark.createDataFrame([([15496, None, 999999, -1],), (None,), ([],), ([255 - 13],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, SOURCE).collect()] == ["Hello", "", "", VOCABULARY.spelled([242]).decode("utf-8", "replace")]


def test_layout_and_repeats_do_not_matter(spark):
    text = "y" * 12_345 + " and more"
    df = rows_of(spark, [text] * 40 + ["plain text"] * 40).repartition(9)
    ids = bpe.encode(df.withColumn("key", F.lit("k")), SOURCE).select("key", "text", "ids").distinct().collect()
    assert {(r.text, tuple(r.ids)) for r in ids} == {(t, tuple(library(t))) for t in (text, "plain text")}


def test_query_equals_the_library(spark, small):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op12_bpe_round_trip"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_pieces_are_merged_in_bounded_arrays(monkeypatch):
    source = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    vocabulary, sizes = bpe.Vocabulary(source), []
    together = vocabulary._merged_together
    monkeypatch.setattr(vocabulary, "_merged_together", lambda pieces: sizes.append(len(pieces)) or together(pieces))
    pieces = [b"w%d" % i for i in range(20_000)]
    assert vocabulary.merged_all(pieces)[::999] == [np.array(vocabulary.merged(p), np.int32).tobytes() for p in pieces[::999]]
    assert max(sizes) <= 1 << 13


def test_a_part_that_is_a_piece_is_remembered_once(monkeypatch):
    known = bpe.Known(VOCABULARY)
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}," for i in range(k, k + 50)) for k in range(0, 600, 50)] + odd_texts(300)
    for slow in (False, True):
        if slow:
            monkeypatch.setattr(bpe, "TOGETHER", 1)
            monkeypatch.setattr(bpe, "KNOWN", 40)  # pieces are forgotten, and learnt again
        ids = bpe.encoded_texts(texts, known)
        assert [np.frombuffer(x, np.int32).tolist() for x in ids] == [library(t) for t in texts]
    known.learn({" alpha", " beta,"})
    known.learn({" alpha"})
    assert list(known) == [" alpha"] and " beta" in known.pieces and " beta," not in known.pieces


def test_rows_are_packed_in_order(monkeypatch):
    monkeypatch.setattr(bpe, "TEXTS", 2)
    rows = [b"\1\0\0\0", None, b"", b"\2\0\0\0\3\0\0\0"]
    assert bpe._lists(iter(rows)).to_pylist() == [[1], None, [], [2, 3]]
    assert bpe._lists([]).to_pylist() == []


def test_results_leave_a_task_some_texts_at_a_time():
    """Before, the tokens and the texts of a whole batch were held until its end."""
    texts = odd_texts(3 * bpe.TEXTS // 2) + [None, "y" * 5000]
    lists = list(bpe.token_lists(iter([pa.array(texts), pa.array([], pa.string()), pa.array(texts[:3])]), bpe.Known(VOCABULARY)))
    assert [len(x) for x in lists] == [bpe.TEXTS, bpe.TEXTS // 2 + 2, 3]
    ids = pa.concat_arrays(lists).to_pylist()
    assert ids == [None if t and len(t) == 5000 else library(t or "") for t in texts + texts[:3]]
    back = list(bpe.spelled_texts(iter([pa.concat_arrays(lists)]), VOCABULARY.bytes_of))
    assert max(map(len, back)) <= bpe.TEXTS and pa.concat_arrays(back).to_pylist() == [
        LIBRARY.decode(i or [], skip_special_tokens=False) for i in ids]
