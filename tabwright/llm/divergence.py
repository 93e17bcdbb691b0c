"""Quality rules: how far a text's characters and common words are from its language's.

References are learnt from all texts of a language that pass the base rules: the share of each class of characters, and the
share of each word that makes up at least ``common`` of the language (at most ``1 / common`` words, by
definition). A text is judged by the Jensen-Shannon distance between its own shares and these. Short
texts have shares that say little, so each comparison has a least number of words. So have languages of few words: the
distance to a language of n words has the weight w = n / (n + ``trust_words``). The rest of the weight has the distance to the
classes of characters of the whole corpus, with letters of all cases and scripts taken together, as what a language writes
with is no fault; words have no such other reference, so their distance counts w times. The formula is the same at every size. Base rules
(too few words, too much of the text inside repeated word runs) hold for every text.

Defined results: a null text is an empty one; empty texts have no words and fail the base rules; a
null language is a language of its own; very long texts are counted whole; a distance equal to its limit keeps the text, and
a word that makes up just ``common`` of its language is common; repeated rows are judged alike; an empty table gives no rows; of more
than ``MOST_LANGUAGES`` languages, more than there are, those with fewest words have no reference of their own, the same as weight 0.
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.tokens import shingle_hashes, word_hashes
from tabwright.sources.durable import drop_copy, materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "line", "stop", "mark", "symbol", "letter", "other")
MOST_LANGUAGES = 10_000  # with a reference of their own


def _class_table() -> np.ndarray:
    """Class of each code point below 0x250; the last entry is for all others."""
    table = np.full(0x251, CLASSES.index("other"), np.uint8)
    for name, chars in {
        "lower": map(chr, range(97, 123)), "upper": map(chr, range(65, 91)), "digit": "0123456789",
        "blank": " \t\v\f\r", "line": "\n", "stop": ".,", "mark": "!?;:'\"()-", "symbol": SYMBOLS + "+/=@[]^_`{}~\\",
        "letter": (chr(c) for c in range(0xC0, 0x250) if c not in (0xD7, 0xF7)),
    }.items():
        for char in chars:
            table[ord(char)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
LETTERS = [CLASSES.index(c) for c in ("lower", "upper", "letter")]


class References(dict):
    """{lang: reference}; ``fallback`` has the class shares of the whole corpus, None if no text passes the base rules."""

    fallback: np.ndarray | None = None


@dataclass(frozen=True)
class Limits:
    """``*_distance``: largest Jensen-Shannon distance (0 to 1) kept; ``min_``, ``class_`` and ``word_words``: fewest words of a text judged;
    ``trust_words``: of a language whose own reference and the corpus have equal weights."""

    min_words: int = 20
    max_repeat_share: float = 0.3
    window: int = 8
    class_distance: float = 0.34
    class_words: int = 30
    word_distance: float = 0.3
    word_words: int = 100
    common: float = 1 / 200
    trust_words: int = 5_000


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def char_classes(text: bytes) -> np.ndarray:
    """How many characters of each class."""
    return np.bincount(CLASS_OF[np.minimum(code_points(text), 0x250)], minlength=len(CLASSES))


def letters_as_one(classes: np.ndarray, text: bytes | None = None) -> np.ndarray:
    """Histogram with all letters in one class, those of the text that no class of letters has included."""
    folded = classes.astype(float)
    if text is not None and folded[CLASSES.index("other")]:
        # vowel signs belong to the letters before them
        points = code_points(text)
        odd, counts = np.unique(points[CLASS_OF[np.minimum(points, 0x250)] == CLASSES.index("other")], return_counts=True)
        beyond = sum(n for c, n in zip(odd.tolist(), counts.tolist()) if unicodedata.category(chr(c))[0] in "LM")
        folded[CLASSES.index("other")] -= beyond
        folded[LETTERS[0]] += beyond
    folded[LETTERS[0]] = folded[LETTERS].sum()
    folded[LETTERS[1:]] = 0
    return folded


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence, base 2, of two histograms that each add up to 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(max(0.0, parts.sum() / 2)))


def repeated_words(words: np.ndarray, size: int) -> int:
    """Words inside a run of ``size`` words that the text has twice or more."""
    if len(words) < size:
        return 0
    windows = shingle_hashes(words, size)
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    twice = np.flatnonzero(np.isin(windows, again))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def base_failed(words: np.ndarray, n_repeats: int, limits: Limits) -> bool:
    return len(words) < limits.min_words or n_repeats > limits.max_repeat_share * len(words)


def _histograms(limits: Limits, batches):
    """(lang, word, class, n) of each batch: a word's hash, or the number of a class of characters."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = _bytes(batch.column("text"))
        for lang in set(langs):
            classes, words = np.zeros(len(CLASSES), np.int64), []
            for text in (t for t, own in zip(texts, langs) if own == lang):
                found = word_hashes(text)
                if not base_failed(found, repeated_words(found, limits.window), limits):
                    classes += char_classes(text)
                    words.append(found)
            if not words:
                continue
            hashes, counts = np.unique(np.concatenate(words), return_counts=True)
            for word, cls, n in (
                (pa.array(hashes.view(np.int64)), pa.nulls(len(hashes), pa.int32()), counts),
                (pa.nulls(len(CLASSES), pa.int64()), pa.array(np.arange(len(CLASSES), dtype=np.int32)), classes),
            ):
                own = pa.repeat(pa.scalar(lang, pa.string()), len(n))
                yield pa.RecordBatch.from_arrays([own, word, cls, pa.array(n)], names=["lang", "word", "class", "n"])


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang", limits: Limits = Limits()) -> References:
    """{lang: (class shares, hashes of its common words in order, shares of these and of the rest, weight)}.

    Counts cover every text. What reaches the driver is bounded: ten classes and at most
    ``1 / limits.common`` words for each of at most ``MOST_LANGUAGES`` languages.
    """
    counted = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")) \
        .mapInArrow(partial(_histograms, limits), "lang string, word long, class int, n long") \
        .groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))
    counted = materialise(counted)
    totals = {r["lang"]: r["n"] for r in counted.where("word IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()}
    table = docs.sparkSession.createDataFrame([*totals.items()], "own string, total long")
    rows = counted.join(F.broadcast(table), F.col("lang").eqNullSafe(F.col("own"))) \
        .where(F.col("word").isNull() | (F.col("n") >= F.col("total") * limits.common))
    references = References()
    whole = counted.where("class IS NOT NULL").groupBy("class").agg(F.sum("n").alias("n")).collect()
    if sum(r["n"] for r in whole):
        classes = np.zeros(len(CLASSES))
        for r in whole:
            classes[r["class"]] = r["n"]
        references.fallback = letters_as_one(classes) / classes.sum()
    found: dict[str | None, list[dict]] = {}
    for r in rows.select("lang", "word", "class", "n").toArrow().to_pylist() if totals else []:
        found.setdefault(r["lang"], []).append(r)
    drop_copy(counted)
    for name, total in totals.items():
        classes = np.zeros(len(CLASSES))
        for r in (r for r in found[name] if r["word"] is None):
            classes[r["class"]] = r["n"]
        common = [(r["word"] % (1 << 64), r["n"] / total) for r in found[name] if r["word"] is not None]
        common.sort()
        shares = np.array([share for _, share in common])
        references[name] = (classes / max(classes.sum(), 1), np.array([word for word, _ in common], np.uint64),
                            np.append(shares, max(0.0, 1 - shares.sum())), total / (total + limits.trust_words))
    return references


VERDICT = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "class_distance": "double", "word_distance": "double", "base_failed": "boolean", "kept": "boolean",
}


def judge_text(text: bytes, reference: tuple | None, limits: Limits, fallback: np.ndarray | None = None) -> tuple:
    """The values of ``VERDICT`` for one text; a distance that is not judged is None.

    ``fallback``, the class shares of the corpus, has the weight that the language's own reference leaves.
    """
    words = word_hashes(text)
    n = len(words)
    chars = len(text.decode("utf-8", "replace")) - sum(map(text.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    repeats = repeated_words(words, limits.window)
    failed = base_failed(words, repeats, limits)
    by_class = by_word = None
    weight = reference[3] if reference else 0.0
    if n >= limits.class_words and (reference or fallback is not None):
        classes = char_classes(text)
        by_class = weight * js_distance(classes / classes.sum(), reference[0]) if reference else 0.0
        if fallback is not None:
            by_class += (1 - weight) * js_distance(letters_as_one(classes, text) / classes.sum(), fallback)
    if reference and n >= limits.word_words and len(reference[1]):
        place = np.minimum(np.searchsorted(reference[1], words), len(reference[1]) - 1)
        place = np.where(reference[1][place] == words, place, len(reference[1]))
        by_word = weight * js_distance(np.bincount(place, minlength=len(reference[1]) + 1) / n, reference[2])
    far = (by_class or 0) > limits.class_distance or (by_word or 0) > limits.word_distance
    return (n, chars, sum(text.count(c) for c in SYMBOLS.encode()), repeated_lines(text), repeats,
            by_class, by_word, failed, not failed and not far)


def quality_verdict(references: dict, text: Column, lang: Column, limits: Limits = Limits()) -> Column:
    """A struct column with the fields of ``VERDICT``."""
    fallback = getattr(references, "fallback", None)
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}

    @F.arrow_udf(", ".join(f"{k} {v}" for k, v in VERDICT.items()))
    def judge(texts: pa.Array, langs: pa.Array) -> pa.Array:
        rows = [judge_text(t, references.get(own), limits, fallback) for t, own in zip(_bytes(texts), langs.to_pylist())]
        columns = zip(*rows) if rows else [[]] * len(VERDICT)
        return pa.StructArray.from_arrays(
            [pa.array(list(c), kinds[k]) for c, k in zip(columns, VERDICT.values())], names=list(VERDICT))

    # not deterministic for the optimizer: a filter on the verdict must not judge every text twice
    return judge.asNondeterministic()(text.cast("string"), lang.cast("string"))
