"""Benchmark items inside documents, up to an edit distance in words: pigeonhole pieces, then Myers.

An item of n words may differ by k = floor(rate * n) word edits. Cut into k + 1 pieces, at least one of
them is intact in any such place, so exact hits of the pieces (one automaton per task) are the only
places to look at. Each is verified by Myers' bit-parallel distance, with words as letters, on the
item's place and k words to either side. Words are runs of letters, digits and underscores, in lower case.

The items are the query set: they are read in blocks of at most ``BLOCK_CHARS`` characters, each of which
is scanned against all documents, so no benchmark is too large for a task.

Defined results: null and empty texts hit nothing, nor do items without a word, among them null ones; items with
fewer than ``min_words`` words are looked for word for word, without an edit; very long texts are searched whole, and
of several places of an item the closest one counts, the first of equally close ones; repeated rows are judged alike;
rows without an id are judged by their text; empty tables give no hits.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from tabwright.llm.tokens import free_name

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_CHARS = 8_000_000
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Budget:
    """``rate``: word edits allowed per word of an item; ``min_words``: of an item that may differ at all."""

    rate: float = 0.2
    min_words: int = 8


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def cut_pieces(words: list[str], count: int) -> list[tuple[int, list[str]]]:
    """(place, words) of ``count`` pieces of near-equal length."""
    edges = [len(words) * i // count for i in range(count + 1)]
    return [(at, words[at:end]) for at, end in zip(edges, edges[1:])]


class Pattern:
    """Myers' bit vectors of one item."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.places: dict[str, int] = {}
        for i, word in enumerate(words):
            self.places[word] = self.places.get(word, 0) | 1 << i

    def best(self, text: list[str]) -> tuple[int, int]:
        """(least distance of the item to any run of the text's words, end of the first such run)."""
        full, high = (1 << self.size) - 1, 1 << self.size - 1
        plus, minus, score, best, end = full, 0, self.size, self.size, 0
        for i, word in enumerate(text):
            equal = self.places.get(word, 0)
            vertical = equal | minus
            horizontal = (((equal & plus) + plus) ^ plus) | equal
            up, down = minus | ~(horizontal | plus) & full, plus & horizontal
            score += (up & high > 0) - (down & high > 0)
            up, down = up << 1 & full, down << 1 & full
            plus, minus = down | ~(vertical | up) & full, up & vertical
            if score < best:
                best, end = score, i + 1
        return best, end


class Finder:
    """Automaton over the pieces of all items of a block."""

    def __init__(self, items: list[str | None], budget: Budget):
        self.patterns: dict[int, tuple[Pattern, int]] = {}
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        for number, text in enumerate(items):
            words = words_of(text or "")
            if not words:
                continue
            edits = int(budget.rate * len(words)) if len(words) >= budget.min_words else 0
            self.patterns[number] = Pattern(words), edits
            for at, piece in cut_pieces(words, edits + 1):
                pieces.setdefault(f" {' '.join(piece)} ", []).append((number, at, len(piece)))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item, distance, word at which the match ends) of each item within its budget, the closest place."""
        if not text or not self.patterns:
            return []
        words = words_of(text)
        line = f" {' '.join(words)} "
        places: dict[tuple[int, int], None] = {}
        at_char = at_word = 0
        for end, (length, owners) in self.automaton.iter(line):
            start = end - length + 1
            if start >= at_char:  # words before this place, counted on from the last one
                at_word += line.count(" ", at_char, start)
            else:
                at_word -= line.count(" ", start, at_char)
            at_char = start
            for number, at, _ in owners:
                places[number, at_word - at] = None
        found: dict[int, tuple[int, int]] = {}
        for number, start in places:
            pattern, edits = self.patterns[number]
            if found.get(number, (edits + 1,))[0] == 0:
                continue
            low = max(0, start - edits)
            distance, end = pattern.best(words[low: start + pattern.size + edits])
            if distance <= edits:
                found[number] = min(found.get(number, (edits + 1, 0)), (distance, low + end))
        return [(number, *rest) for number, rest in sorted(found.items())]


HIT = "array<struct<item: {}, distance: int, ends: int>>"


def hits(text: Column, ids: list, items: list[str | None], id_type: str, budget: Budget) -> Column:
    """Array of (item, distance, ends) of one block of items in each text."""
    arrow_id = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}.get(id_type, pa.string())
    kind = pa.list_(pa.struct([("item", arrow_id), ("distance", pa.int32()), ("ends", pa.int32())]))

    @F.arrow_udf(HIT.format(id_type))
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = Finder(items, budget)  # once a task
        for texts in batches:
            yield pa.array([[{"item": ids[n], "distance": d, "ends": e} for n, d, e in finder.find(t.as_py())]
                            for t in texts], kind)

    return search.asNondeterministic()(text.cast("string"))


def item_blocks(items: DataFrame, id: str, text: str) -> Iterator[tuple[list, list]]:
    """(ids, texts) of the items in blocks of at most about ``BLOCK_CHARS`` characters, one at a time."""
    own = items.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    total = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    count = max(1, -(-total // BLOCK_CHARS))
    for k in range(count):
        block = own.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k).orderBy("id", "text").toArrow()
        yield block["id"].to_pylist(), block["text"].to_pylist()


def with_hits(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
              budget: Budget = Budget(), into: str = "hits") -> DataFrame:
    """The documents with one more column, the array of hits, under ``into`` or the next free name (the last column)."""
    kind = items.schema[item_id].dataType
    if not isinstance(kind, (LongType, StringType)) and kind.simpleString() not in ("int", "smallint", "tinyint"):
        items, kind = items.withColumn(item_id, F.col(f"`{item_id}`").cast("string")), StringType()
    parts = [hits(F.col(f"`{text}`"), ids, texts, kind.simpleString(), budget)
             for ids, texts in item_blocks(items, item_id, item_text)]
    name = free_name(docs, into)
    return docs.withColumn(name, reduce(F.concat, parts))
