"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

A byte-level BPE with the common pattern cuts a text into pieces that it encodes on their own. The cuts are
found on arrays of code points; the library is asked for pieces not met before, and the answers are kept in a table of
bounded size. Texts with code points beyond PLAIN, or with a special token's string, go to the library whole.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np

from waymark.llm import words

#: code points up to here are cut by arrays; rows with others go to the library as they are
PLAIN = 0x2E7F
#: pieces remembered by a worker
KEPT = 600_000
_BLANKS = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F]
_LETTER, _NUMBER, _BLANK, _OTHER = 1, 2, 3, 4


@lru_cache(maxsize=1)
def _byte_letters() -> dict[int, int]:
    """Code point that stands for each byte in a byte-level vocabulary: itself where it prints, else 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {b: b for b in prints} | {b: 256 + i for i, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def _letter_points() -> np.ndarray:
    """``_byte_letters`` as UTF-32 code points by byte."""
    return np.array([_byte_letters()[b] for b in range(256)], "<u4")


def byte_letters(texts: list[str]) -> list[str]:
    """Each text with its UTF-8 bytes as letters of a byte-level vocabulary.

    All texts are looked up at once; byte FF, which UTF-8 never holds, stands between them and for itself.
    """
    joined = np.frombuffer(b"\xff".join([x.encode() for x in texts]), np.uint8)
    return _letter_points()[joined].tobytes().decode("utf-32-le").split("\xff")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    import unicodedata

    first = [unicodedata.category(chr(c))[0] for c in range(PLAIN + 1)]
    made = np.array([_LETTER if x == "L" else _NUMBER if x == "N" else _OTHER for x in first], np.uint8)
    made[_BLANKS] = _BLANK
    return made


def cuts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of all pieces of rows of code points; every row starts a piece."""
    n = len(points)
    kind = _kinds()[points]
    space = points == 32
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 0, kind[:-1]
    before[first[:n]] = 0
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = 0, kind[1:]
    after[first[1:]] = 0
    led = np.zeros(n, bool)  # a plain space in front belongs to the piece
    led[1:] = space[:-1]
    led &= before == _BLANK
    blank = kind == _BLANK
    start = np.where(blank, (before != _BLANK) | ((after != _BLANK) & (after != 0)), (kind != before) & ~led)
    for at in np.flatnonzero((points == 39) & start & (before != _OTHER)).tolist():
        end = int(bounds[np.searchsorted(bounds, at, side="right")])
        tail = "".join(map(chr, points[at + 1 : min(at + 3, end)].tolist()))
        size = 2 if tail[:1] in ("s", "t", "m", "d") and tail else 3 if tail in ("re", "ve", "ll") else 0
        if size:
            start[at + 1] = False
            if at + size < end:
                start[at + size] = True
    return np.flatnonzero(start)


def _beyond(text: str) -> bool:
    return bool(np.frombuffer(text.encode("utf-32-le"), np.uint32).max() > PLAIN)


class Encoder:
    """ids of texts under one tokenizer file; with ``plain``, strings of special tokens are ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[int, int] = {}
        self.arena = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(KEPT + 1, np.int64)

    def _add(self, hashes: list[int], texts: list[str]) -> None:
        tokenize = self.tokenizer.model.tokenize
        found = [[t.id for t in tokenize(x)] for x in byte_letters(texts)]
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        while self.used + len(flat) > len(self.arena):
            self.arena = np.concatenate([self.arena, np.zeros_like(self.arena)])
        self.arena[self.used : self.used + len(flat)] = flat
        at = len(self.place)
        if at + len(hashes) + 1 > len(self.start):
            self.start = np.concatenate([self.start, np.zeros(at + len(hashes) + 1 - len(self.start), np.int64)])
        self.start[at + 1 : at + 1 + len(found)] = self.used + np.cumsum([len(x) for x in found])
        self.used += len(flat)
        self.place.update(zip(hashes, range(at, at + len(hashes)), strict=True))

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text)."""
        whole = "".join(texts)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = cuts(points, bounds)
        ends = np.append(starts[1:], len(points))
        power, inverse = words._power_tables(len(points))
        total = np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], dtype=np.uint64)
        left = np.where(starts > 0, total[starts - 1], np.uint64(0))
        hashes = words.mix((total[ends - 1] - left) * inverse[starts])
        distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.place) + len(distinct) > KEPT:
            self._forget()
        keys = distinct.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.place]
        if new:
            a, b = starts[at[new]].tolist(), ends[at[new]].tolist()
            self._add([keys[i] for i in new], [whole[x:y] for x, y in zip(a, b, strict=True)])
        slot = np.array([self.place[h] for h in keys], np.int64)[back]
        begin = self.start[slot]
        size = self.start[slot + 1] - begin
        done = np.cumsum(size)
        ids = self.arena[np.repeat(begin - (done - size), size) + np.arange(done[-1])]
        upto = np.concatenate([[0], done])[np.searchsorted(starts, bounds)]
        return ids, np.diff(upto)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        made: list[np.ndarray | None] = [None] * len(texts)
        group, size = [], 0
        for i, text in enumerate(texts):
            if not text.isascii() and _beyond(text) or any(s in text for s in self.special):
                made[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
                continue
            group.append(i)
            size += len(text)
            if size >= words.CHUNK:
                self._fill(made, texts, group)
                group, size = [], 0
        self._fill(made, texts, group)
        return made

    def _fill(self, made: list, texts: list[str], group: list[int]) -> None:
        ids, sizes = self._chunk([texts[i] for i in group])
        for i, part in zip(group, np.split(ids, np.cumsum(sizes)[:-1]) if group else [], strict=True):
            made[i] = part


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and file; its memory of pieces lasts over tasks."""
    return Encoder(path)
