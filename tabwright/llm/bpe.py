"""Byte-level BPE encoding and decoding of whole texts, long unsplit runs by concatenating a tree.

A text is cut before each blank that follows something else: no token reaches over such a place, so the parts
between (a run of blanks and the word after it) are encoded on their own and remembered. In a part, special
tokens are split off, then the byte-level pattern gives pieces, and merges join the bytes of a piece by rank.

A piece beyond ``LEAF`` bytes (a long unsplit run) is halved until its leaves are small enough. Leaves are rows, dealt
to all tasks and encoded in parallel. Neighbours are then joined up the tree: the tokens around the join are encoded anew
in a window that doubles until its first token is the left side's own token there and its last one the right
side's. A token sequence is the encoding of its bytes exactly if each two neighbours in it are, and the pairs at the rim of
such a window stood in one of the sides, so the result is that of the whole piece.

Rows without such a piece take one pass: no shuffle, nothing stored. Rows with one are stored with a random key first.

Defined results: a null or empty text has no tokens and decodes to an empty text. Texts of any length are encoded whole.
Repeated rows and rows without an id give the same as others; an empty table gives no rows; other columns are kept, and new names get underscores where they clash.
Equal ranks cannot happen; of equal pairs the left one merges first. Token ids that are not in the vocabulary decode to nothing,
as do null ids; bytes that are no UTF-8 become replacement characters; null ids arrays decode to an empty text.
Letters and digits are those of Python's Unicode tables; characters newer than these count as symbols.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.tokens import INSIDE, free_name
from tabwright.sources.durable import materialise

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF = 4096  # most bytes of a leaf
SHORT = 100  # most bytes of what is merged pair by pair, and most characters of what is remembered
TOGETHER = 1 << 17  # parts that are looked up at a time
MERGED = 1 << 13  # pieces that are merged at a time, up to ``SHORT`` columns in each of several arrays
KNOWN = 1 << 18  # pieces whose tokens a task remembers
TEXTS = 512  # texts that are encoded, and rows that are decoded, before they are packed
SLICE = 1 << 20  # characters of a text that are cut into parts at a time
WINDOW = 8  # tokens on either side of a join to begin with

# Code points of the blanks of the byte-level pattern.
BLANKS = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLANK = "".join(map(chr, BLANKS))
PARTS = re.compile(f"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
PLACE = re.compile(f"[^{BLANK}](?=[{BLANK}])")
# Fixed value: the pattern of byte-level BPE.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE vocabulary read from the JSON of a tokenizer file."""

    def __init__(self, source: str):
        file = json.loads(source)
        byte_of, ids = _byte_letters(), file["model"]["vocab"]

        def spelled(token: str) -> bytes:
            return bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()

        self.bytes_of = {i: spelled(t) for t, i in ids.items()}
        self.id_of_byte = [ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in file["model"]["merges"]]
        self.ranks = {(ids[left], ids[right]): rank for rank, (left, right) in enumerate(pairs)}
        self.made = [ids[left + right] for left, right in pairs]  # the token of each rank
        self.none = len(pairs)
        self._id_of_byte, self._made = np.array(self.id_of_byte, np.int32), np.array(self.made, np.int32)
        coded = np.array([(a << 32) | b for a, b in self.ranks], np.int64)
        self._rank_of_pair = np.argsort(coded)
        self._pairs = coded[self._rank_of_pair]
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        self.bytes_of |= {i: spelled(t) for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def merged(self, data: bytes) -> list[int]:
        """Tokens of one piece: the pair of lowest rank merges, the leftmost first, until none is left."""
        return self._merged_long(data) if len(data) > SHORT else self._merged_short(data)

    def merged_all(self, pieces: list[bytes]) -> list[bytes]:
        """32-bit tokens of many short pieces: one merge in each of them at a time."""
        out: list[bytes] = [b""] * len(pieces)
        by_length = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
        for at in range(0, len(pieces), MERGED):
            some = by_length[at: at + MERGED]
            for i, ids in self._merged_together([pieces[i] for i in some]):
                out[some[i]] = ids
        return out

    def _merged_together(self, pieces: list[bytes]) -> Iterator[tuple[int, bytes]]:
        sizes = np.array([len(p) for p in pieces])
        width = max(int(sizes.max()), 2)
        filled = np.arange(width) < sizes[:, None]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[filled] = self._id_of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self._rank_array(ids[:, :-1], ids[:, 1:])
        row, columns = np.arange(len(pieces)), np.arange(width)
        while len(row):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(row)), at]
            going = best < self.none
            for k in np.flatnonzero(~going).tolist():
                yield int(row[k]), ids[k, :sizes[k]].tobytes()
            row, at, best, ids, ranks, sizes = row[going], at[going], best[going], ids[going], ranks[going], sizes[going] - 1
            every = np.arange(len(row))
            ids[every, at] = self._made[best]
            # columns behind the pair move up by one; the last one is empty from now on
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(columns[:-1] + (columns[:-1] >= at[:, None]), width - 2), axis=1)
            ranks[:, -1] = self.none
            after = np.minimum(at + 1, width - 1)
            right = at < width - 1
            ranks[every[right], at[right]] = self._rank_array(ids[every, at], ids[every, after])[right]
            left = at > 0
            ranks[every[left], at[left] - 1] = self._rank_array(ids[every, np.maximum(at - 1, 0)], ids[every, at])[left]

    def _rank_array(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self._pairs, wanted), len(self._pairs) - 1)
        return np.where(self._pairs[at] == wanted, self._rank_of_pair[at], self.none)

    def _merged_short(self, data: bytes) -> list[int]:
        ids = [self.id_of_byte[b] for b in data]
        rank_of, none = self.ranks.get, self.none
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == none:
                break
            i = ranks.index(rank)
            ids[i] = self.made[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), none)
        return ids

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with the pairs in a heap."""
        ids = [self.id_of_byte[b] for b in data]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        find = self.ranks.get
        waiting = [(rank, i) for i in range(n - 1) if (rank := find((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, i = heapq.heappop(waiting)
            j = after[i] if alive[i] else n
            if j >= n or find((ids[i], ids[j])) != rank:
                continue
            ids[i], alive[j] = self.made[rank], False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := find((ids[i], ids[k]))) is not None:
                    heapq.heappush(waiting, (rank, i))
            h = before[i]
            if h >= 0 and (rank := find((ids[h], ids[i]))) is not None:
                heapq.heappush(waiting, (rank, h))
        return [t for t, kept in zip(ids, alive) if kept]

    def pieces(self, part: str) -> list[str | int]:
        """The pieces of a part, and ids of the special tokens in it."""
        if self.specials is None or not self.specials.search(part):
            return _split(part)
        out, at = [], 0
        for special in self.specials.finditer(part):
            out += [*_split(part[at:special.start()]), self.special[special[0]]]
            at = special.end()
        return out + _split(part[at:])

    def spelled(self, tokens: list[int]) -> bytes:
        return b"".join([self.bytes_of.get(t, b"") for t in tokens])

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both sides, each of which is an encoding."""
        size = WINDOW
        while left and right:
            i, j = max(0, len(left) - size), min(len(right), size)
            window = self.merged(self.spelled(left[i:] + right[:j]))
            if (i == 0 or window[0] == left[i]) and (j == len(right) or window[-1] == right[j - 1]):
                return left[:i] + window + right[j:]
            size *= 2
        return left + right

    def tree(self, leaves: list[list[int]]) -> list[int]:
        """Neighbours joined level by level; leaves are those of ``halves``."""
        while len(leaves) > 1:
            leaves = [self.joined(*leaves[i: i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []


def _split(text: str) -> list[str]:
    """Pieces of a text by the pattern."""
    if text.isascii():
        return PIECES.findall(text)
    # what is unassigned here may be a letter in the tables of ``regex``
    newer = {ord(c): 0xFFFF for c in set(text) if unicodedata.category(c) == "Cn"}
    if not newer:
        return PIECES.findall(text)
    return [text[piece.start():piece.end()] for piece in PIECES.finditer(text.translate(newer))]


def halves(data: bytes, most: int = LEAF) -> list[bytes]:
    """The piece in 2**k leaves of about equal length, at most ``most`` bytes each."""
    leaves = 1
    while leaves * most < len(data):
        leaves *= 2
    cuts = [len(data) * i // leaves for i in range(leaves + 1)]
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def parts(text: str) -> Iterator[list[str]]:
    """The parts of a text that no token reaches over, some at a time."""
    at = 0
    while at < len(text):
        place = PLACE.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = place.end() if place else len(text)
        yield PARTS.findall(text[at:end])
        at = end


class Known(dict):
    """Part to the 32-bit ids of its tokens, for the parts that are looked up now; pieces are remembered longer.

    Most parts are one piece, so a part that equals a remembered piece needs no work.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = b"".join([array("i", [piece]).tobytes() if isinstance(piece, int) else self.pieces.get(piece) or self._of_piece(piece)
                        for piece in self.vocabulary.pieces(part)])
        if len(part) <= SHORT:
            if len(self) >= KNOWN:
                self.clear()
            self[part] = ids
        return ids

    def _of_piece(self, piece: str) -> bytes:
        data = piece.encode()
        ids = array("i", self.vocabulary.tree([self.vocabulary.merged(x) for x in halves(data)])).tobytes()
        if len(data) <= SHORT:
            if len(self.pieces) >= KNOWN:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def learn(self, some: set[str]) -> None:
        """Encode these parts together. Other parts are forgotten, pieces only when there are too many."""
        self.clear()
        if len(self.pieces) + len(some) > KNOWN:
            self.pieces.clear()
        self.update({p: self.pieces[p] for p in some if p in self.pieces})
        # parts that begin with a blank and end with something else stay apart when they stand in a row
        new = [p for p in some if p not in self and 1 < len(p) <= SHORT and p[0] in BLANK and p[-1] not in BLANK]
        text = "".join(new)
        if not new or self.vocabulary.specials is not None and self.vocabulary.specials.search(text):
            return
        pieces = _split(text)
        fresh = [p for p in set(pieces) if p not in self.pieces]
        self.pieces.update(zip(fresh, self.vocabulary.merged_all([p.encode() for p in fresh])))
        ids = list(map(self.pieces.__getitem__, pieces))
        ends = np.searchsorted(np.cumsum([len(p) for p in pieces]), np.cumsum([len(p) for p in new])) + 1
        at = 0
        for part, end in zip(new, ends.tolist()):
            self[part] = b"".join(ids[at:end])
            at = end


def encoded_texts(texts: Iterable[str | None], known: Known) -> list[bytes | None]:
    """32-bit ids of the tokens of each text; None for a text with a long piece."""
    out: list[list[bytes] | bytes | None] = []
    waiting: list[tuple[int, list[str]]] = []

    def settle() -> None:
        known.learn({p for _, some in waiting for p in some})
        for i, some in waiting:
            out[i].append(b"".join(map(known.__getitem__, some)))
        waiting.clear()

    held = 0
    for text in texts:
        if text and has_long_piece(text):
            out.append(None)
            continue
        out.append([])
        for some in parts(text or ""):
            waiting.append((len(out) - 1, some))
            held += len(some)
            if held >= TOGETHER:
                settle()
                held = 0
    settle()
    for i, ids in enumerate(out):  # one text at a time, so that its tokens are held once
        out[i] = None if ids is None else b"".join(ids)
    return out


def has_long_piece(text: str) -> bool:
    """True if a piece is beyond ``LEAF`` bytes. Few texts have a run of that many bytes at all."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) <= LEAF:
        return False
    inside = INSIDE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if np.diff(np.r_[-1, edges, len(data) - 1]).max() < LEAF - 1:  # a piece may hold one blank before its run
        return False
    return any(len(piece.encode()) > LEAF for some in parts(text) for part in some for piece in _split(part))


def _lists(rows: Iterable[bytes | None]) -> pa.Array:
    """32-bit ids as an Arrow column of lists."""
    data, ends, missing = bytearray(), [0], []
    for row in rows:
        data += row or b""
        ends.append(len(data) // 4)
        missing.append(row is None)
    return pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.array(np.frombuffer(data, np.int32)), mask=pa.array(missing, pa.bool_()))


def token_lists(batches: Iterable[pa.Array], known: Known) -> Iterator[pa.Array]:
    """The tokens of texts, at most ``TEXTS`` at a time, however long the batches are; null for a text with a long piece."""
    for texts in batches:
        for at in range(0, len(texts), TEXTS):
            yield _lists(encoded_texts((t.as_py() for t in texts[at: at + TEXTS]), known))


def spelled_texts(batches: Iterable[pa.Array], bytes_of: dict[int, bytes]) -> Iterator[pa.Array]:
    """The texts of lists of tokens, at most ``TEXTS`` at a time."""
    table = [bytes_of.get(i, b"") for i in range(max(bytes_of) + 2)]  # the last one is of no token

    def text(row: pa.ListScalar) -> str:
        tokens = np.zeros(0, np.int64) if row.values is None else row.values.fill_null(-1).to_numpy(zero_copy_only=False)
        known = np.where((tokens >= 0) & (tokens < len(table)), tokens, -1)
        return b"".join(map(table.__getitem__, known.tolist())).decode("utf-8", "replace")

    for lists in batches:
        for at in range(0, len(lists), TEXTS):
            yield pa.array([text(row) for row in lists[at: at + TEXTS]], pa.string())


def encoded(text: Column, vocabulary) -> Column:
    """array<int>: the tokens of a text without long pieces, by a broadcast tokenizer file; null for other texts."""
    @F.arrow_udf("array<int>")
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from token_lists(batches, Known(Vocabulary(vocabulary.value)))

    return encode_texts.asNondeterministic()(text)


def decoded(ids: Column, vocabulary) -> Column:
    """The text that tokens stand for."""
    @F.arrow_udf("string")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from spelled_texts(batches, Vocabulary(vocabulary.value).bytes_of)

    return decode_ids.asNondeterministic()(ids)


def _leaves(long: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """(key, part, leaf, data, done): tokens of the ordinary parts, and leaves of long pieces still to be encoded."""
    def cut(batches):
        words = Vocabulary(vocabulary.value)
        known = Known(words)
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, ready, n = [], [], 0

                def close():
                    nonlocal n
                    rows.append((row, n, 0, b"".join(ready), True))
                    ready.clear()
                    n += 1

                for some in parts(value):
                    for part in some:
                        if len(part) < LEAF // 4:
                            ready.append(known[part])
                            continue
                        for piece in words.pieces(part):
                            piece = piece if isinstance(piece, int) else piece.encode()
                            if isinstance(piece, int) or len(piece) <= LEAF:
                                ready.append(array("i", [piece] if isinstance(piece, int) else words.merged(piece)).tobytes())
                                continue
                            close()
                            rows += [(row, n, i, leaf, False) for i, leaf in enumerate(halves(piece))]
                            n += 1
                close()
                for at in range(0, len(rows), 1024):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at: at + 1024]), (
                        pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()))], ["key", "part", "leaf", "data", "done"])

    return long.select(F.col(key).alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(
        cut, "key string, part long, leaf long, data binary, done boolean")


def _tree_encoded(long: DataFrame, key: str, text: str, vocabulary) -> DataFrame:
    """(key, ids): long pieces encoded leaf by leaf in all tasks, and joined with the rest of their text."""
    def encode_leaves(batches):
        words = Vocabulary(vocabulary.value)
        for batch in batches:
            data = [d if done else np.array(words.merged(d), np.int32).tobytes()
                    for d, done in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield batch.set_column(3, "data", pa.array(data, pa.binary()))

    def concatenate(group: pa.Table) -> pa.Table:
        words = Vocabulary(vocabulary.value)
        rows = sorted(group.select(["part", "leaf", "data", "done"]).to_pylist(), key=lambda r: (r["part"], r["leaf"]))
        out, waiting = [], []
        for k, r in enumerate(rows):
            if r["done"]:
                out.append(r["data"])
                continue
            waiting.append(np.frombuffer(r["data"], np.int32).tolist())
            if k + 1 == len(rows) or rows[k + 1]["part"] != r["part"]:
                out.append(np.array(words.tree(waiting), np.int32).tobytes())
                waiting = []
        return pa.table({"key": group["key"].slice(0, 1), "ids": _lists([b"".join(out)])})

    spread = _leaves(long, key, text, vocabulary).repartition("key", "part", "leaf")
    done = spread.mapInArrow(encode_leaves, spread.schema)
    return done.groupBy("key").applyInArrow(concatenate, "key string, ids array<int>")


def is_long(text: Column) -> Column:
    """``has_long_piece`` of a column."""
    @F.arrow_udf("boolean")
    def longest(texts: pa.Array) -> pa.Array:
        return pa.array([has_long_piece(t.as_py() or "") for t in texts], pa.bool_())

    return longest(text)


def encode(df: DataFrame, source: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``df`` with ``into``: the token ids of its whole texts. ``source`` is the JSON of a tokenizer file."""
    vocabulary = df.sparkSession.sparkContext.broadcast(source)
    into, key = free_name(df, into), free_name(df, "key")
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = df.withColumn(into, encoded(value, vocabulary)).where(F.col(f"`{into}`").isNotNull())
    long = materialise(df.where(is_long(value)).withColumn(key, F.expr("uuid()")))
    if long.isEmpty():
        return plain
    ids = _tree_encoded(long, key, text, vocabulary).withColumnsRenamed({"key": f"{key}_", "ids": into})
    joined = long.join(ids, F.col(key) == F.col(f"{key}_")).drop(key, f"{key}_")
    return plain.unionByName(joined.select(*[f"`{c}`" for c in plain.columns]))


def decode(df: DataFrame, source: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` with ``into``: the text of the token ids in the array column ``ids``."""
    vocabulary = df.sparkSession.sparkContext.broadcast(source)
    return df.withColumn(free_name(df, into), decoded(F.col(f"`{ids}`"), vocabulary))


def read_vocabulary(path: str) -> str:
    """A tokenizer file of the driver's machine, which broadcasts it."""
    with open(path, encoding="utf-8") as file:
        return file.read()
