"""Whole Arrow columns of text as arrays of 64-bit word and shingle hashes.

Word classes are decided on UTF-8 bytes: every byte of a code point above 127 is above 127 itself,
so classes that name ASCII characters only are the same on bytes as on characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: bytes of text hashed at once; a longer text is a chunk of its own
CHUNK = 1 << 18


@lru_cache(maxsize=None)
def _byte_tables(kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, its value after lower-casing A-Z) for a word class.

    ``blank``: words are ``[^\\x20\\x09-\\x0D]+``; ``alnum``: ``[0-9A-Za-z]`` and all beyond ASCII.
    """
    b = np.arange(256)
    lower = np.where((b >= 65) & (b <= 90), b + 32, b)
    if kind == "blank":
        word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    else:
        word = ((lower >= 48) & (lower <= 57)) | ((lower >= 97) & (lower <= 122)) | (b >= 128)
    return word, (lower + 1).astype(np.uint64)


_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for step in (_BASE, _INVERSE):
            t = np.full(size, step, np.uint64)
            t[0] = 1
            made.append(np.multiply.accumulate(t))
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets from 0) of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most CHUNK bytes (one row at least)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each lower-cased word in order, word offsets per row)."""
    n = len(data)
    rows = len(offsets) - 1
    if not n:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    is_word, value = _byte_tables(kind)
    inside = is_word[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after)
    power, inverse = _power_tables(n)
    total = np.cumsum(value[data] * power[:n], dtype=np.uint64)
    left = np.where(starts > 0, total[starts - 1], np.uint64(0))
    hashes = mix((total[ends] - left) * inverse[starts])
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


@lru_cache(maxsize=None)
def _weights(k: int) -> np.ndarray:
    return mix(np.arange(1, k + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, regardless of row borders (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, w in enumerate(_weights(k)):
        total += words[j : j + n] * w
    return mix(total + np.uint64(k))


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per row: sorted distinct shingle hashes; fewer than k words give one shingle, none give none."""
    grams = gram_hashes(words, k)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            found = np.sort(grams[a : b - k + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:
            yield gram_hashes(words[a:b], b - a)
        else:
            yield words[:0]


def row_shingles(column: pa.Array, kind: str, k: int) -> Iterator[np.ndarray]:
    """``shingles`` of each row of a text column."""
    data, offsets = buffer_of(column)
    for first, last in chunks(offsets):
        own = offsets[first : last + 1]
        words, bounds = word_hashes(data[own[0] : own[-1]], own - own[0], kind)
        yield from shingles(words, bounds, k)
