from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import divergence as d

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for k in range(len(words) - 7):
        windows.setdefault(tuple(words[k:k + 8]), []).append(k)
    covered = {i for places in windows.values() if len(places) > 1 for k in places for i in range(k, k + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def judged(spark, rows, schema="doc_id long, text string, lang string", limits=d.Limits()):
    docs = spark.createDataFrame(rows, schema)
    references = d.language_references(docs, limits=limits)
    verdict = d.quality_verdict(references, F.col("text"), F.col("lang"), limits)
    return docs.withColumn("v", verdict).select("doc_id", "v.*").collect(), references


ODD = [None, "", " \n\t", "word", "a b c d e f g h " * 5, "x\ny\nx\n \nx", "é ü|<> #1 $%&*", "a\x0bb\x0cc\rd\x1ce f", "w " * 30,
       "ab " * 40_000, "\n".join(f"line {k % 7} of text" for k in range(60)), "x" * 200_000]


def test_base_counts_equal_brute_force(spark, small):
    texts = ODD + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    found, _ = judged(spark, [(k, t, "en") for k, t in enumerate(texts)])
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_distances_equal_plain_sums(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    limits = d.Limits(trust_words=0)
    found, references = judged(spark, [tuple(r) for r in docs], limits=limits)
    counts, chars = {}, {}
    for r in docs:
        base = brute(r.text)
        if not base[5]:
            own = counts.setdefault(r.lang, {})
            for w in WORD.findall(r.text):
                own[w] = own.get(w, 0) + 1
            chars[r.lang] = chars.get(r.lang, 0) + d.char_classes(r.text.encode())
    for lang, (classes, hashes, shares, weight) in references.items():
        assert weight == 1
        total = sum(counts[lang].values())
        common = sorted((n / total for n in counts[lang].values() if n >= total / 200))
        assert sorted(shares[:-1]) == pytest.approx(common) and len(hashes) == len(common)
        assert classes == pytest.approx(chars[lang] / chars[lang].sum())
    by_id = {r.doc_id: r for r in docs}
    for r in found:
        doc = by_id[r.doc_id]
        if r.class_distance is not None:
            p, q = d.char_classes(doc.text.encode()).astype(float), references[doc.lang][0]
            p, m = p / p.sum(), (p / p.sum() + q) / 2
            with np.errstate(divide="ignore", invalid="ignore"):
                plain = sum(x * np.log2(x / y) for x, y in zip(p, m) if x) + sum(x * np.log2(x / y) for x, y in zip(q, m) if x)
            assert r.class_distance == pytest.approx((plain / 2) ** 0.5)


def test_clean_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    references = d.language_references(docs)
    rows = docs.join(labels, "doc_id").withColumn("v", d.quality_verdict(references, F.col("text"), F.col("lang"))) \
        .select("quality", "v.*").collect()
    good = [r for r in rows if r.quality and not r.base_failed]
    bad = [r for r in rows if not r.quality]
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(not r.kept for r in bad) > 0.6 * len(bad)


def test_odd_tables(spark):
    rows = [(1, "some words " * 20, None, 5), (None, None, "xx", 6), (2, "x", "en", None)]
    found, references = judged(spark, rows, "doc_id long, text string, lang string, kept int")
    assert references == {} and len(found) == 3
    assert judged(spark, [])[0] == []


def test_rare_languages_are_judged(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    found, references = judged(spark, [tuple(r) for r in docs])
    by_id, langs = {r.doc_id: r for r in found}, {r.doc_id: r.lang for r in docs}
    assert all(0.5 < references[lang][3] < 0.9 for lang in ("es", "fr"))
    assert all(by_id[k].class_distance is not None and not by_id[k].kept for k in (14, 17, 47, 48))
    rare = [r for r in found if langs[r.doc_id] in ("es", "fr") and r.n_words >= 30]
    assert all(r.class_distance is not None for r in rare)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert all(r.kept for r in rare if labels.get(r.doc_id) == 1 and not r.base_failed)
    # a mislabelled or rare code is no free pass, and a script of its own no fault
    rng = random.Random(5)
    greek = " ".join("".join(chr(0x3b1 + rng.randrange(24)) for _ in range(6)) + ("." if k % 9 == 8 else "") for k in range(90))
    more = [(9000, " ".join(f"word{k} &&&***###" for k in range(60)), "zz"), (9001, greek, "el")]
    found, _ = judged(spark, [tuple(r) for r in docs] + more)
    assert {r.doc_id: r.kept for r in found if r.doc_id >= 9000} == {9000: False, 9001: True}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_the_same_rule_at_every_size(spark, folder):
    """Junk goes and clean texts stay in every language, however many words the corpus has of it."""
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{folder}/labels.parquet")
    references = d.language_references(docs)
    rows = docs.join(labels, "doc_id").withColumn("v", d.quality_verdict(references, F.col("text"), F.col("lang"))) \
        .where("NOT v.base_failed AND v.class_distance IS NOT NULL").select("lang", "quality", "v.kept").collect()
    for lang in {r.lang for r in rows}:
        good = [r.kept for r in rows if r.lang == lang and r.quality == 1]
        bad = [not r.kept for r in rows if r.lang == lang and r.quality == 0]
        assert sum(good) >= 0.99 * len(good), lang
        assert sum(bad) >= 0.7 * len(bad), lang


def test_weights_grow_without_a_step():
    text = " ".join(f"word{k} &&&***###" for k in range(60)).encode()
    classes = np.full(len(d.CLASSES), 1 / len(d.CLASSES))
    whole = d.letters_as_one(classes * 100) / 100
    found = []
    for n in (0, 1, 100, 9_999, 10_000, 10_001, 10 ** 9):
        reference = (classes, np.empty(0, np.uint64), np.ones(1), n / (n + 2_000))
        found.append(d.judge_text(text, reference, d.Limits(), whole)[5])
    assert found[0] == d.judge_text(text, None, d.Limits(), whole)[5]
    assert abs(found[3] - found[4]) < 1e-4 > abs(found[4] - found[5])
    assert found == sorted(found) or found == sorted(found, reverse=True)
