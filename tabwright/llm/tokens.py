"""Words of a text, shingles of words, and their 64-bit hashes, as numpy arrays.

A word is a run of anything but the six ASCII blanks, which is what ``bytes.split`` cuts at. Its hash is
a polynomial in its bytes, modulo 2**64, so that all words of a text are hashed by one running sum.
"""

from __future__ import annotations

import re
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANKS = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
WORD = re.compile(rb"[^ \t-\r]+")
BASE = 0x9E3779B97F4A7C1B  # odd, so it has an inverse; 3 modulo 8
BLOCK = 1 << 15  # bytes hashed at a time, which bounds memory on very long texts
ODD = np.random.default_rng(20).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(BLOCK, base, np.uint64)])


# these travel with every function that hashes words, so they are kept small
INSIDE = np.ones(256, np.int8)  # per byte: part of a word
INSIDE[[9, 10, 11, 12, 13, 32]] = 0
FOLDED = np.arange(256, dtype=np.uint8)  # per byte: A-Z as a-z
FOLDED[65:91] += 32
POWERS, INVERSE = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))


def _block_hashes(text: bytes, lower: bool) -> np.ndarray:
    chars = np.frombuffer(text, np.uint8)
    padded = np.zeros(len(chars) + 2, np.int8)
    padded[1:-1] = INSIDE[chars]
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    running = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((FOLDED[chars] if lower else chars) * POWERS[:len(chars)], out=running[1:])
    return mixed((running[ends] - running[starts]) * INVERSE[starts] + (ends - starts).astype(np.uint64) * ODD[-1])


def _long_word_hash(word: bytes, lower: bool) -> np.ndarray:
    """Of one word of any length: the same value, summed block by block."""
    total, factor = 0, 1
    for at in range(0, len(word), BLOCK):
        chars = np.frombuffer(word[at: at + BLOCK], np.uint8)
        total += factor * int(((FOLDED[chars] if lower else chars) * POWERS[:len(chars)]).sum(dtype=np.uint64))
        factor = factor * int(POWERS[len(chars)]) % (1 << 64)
    return mixed(np.array([(total + len(word) * int(ODD[-1])) % (1 << 64)], np.uint64))


def word_hashes(text: bytes, lower: bool = False) -> np.ndarray:
    """One uint64 per word, in order; ``lower`` folds A-Z only."""
    if len(text) <= BLOCK:
        return _block_hashes(text, lower)
    parts, at = [], 0
    while at < len(text):
        end = min(at + BLOCK, len(text))
        if end < len(text):  # back to the last blank, so that no word is cut
            end = max(text.rfind(blank, at, end) for blank in BLANKS)
        if end > at:
            parts.append(_block_hashes(text[at:end], lower))
        elif word := WORD.match(text, at):  # one that is longer than a block
            parts.append(_long_word_hash(word[0], lower))
            end = word.end()
        else:  # a blank, then such a word
            end = at + 1
        at = end
    return np.concatenate(parts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over all bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One uint64 per run of ``size`` words, in order and with repeats.

    Fewer words make one shingle of the whole sequence; no words make none.
    """
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += words[k: n - size + 1 + k] * ODD[k]
    return mixed(total)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until the frame has no such column (letter case aside)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
