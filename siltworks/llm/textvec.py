"""Vectorised text scanning in numpy: words, their hashes and word n-grams of many texts at once.

A batch of texts becomes one array of code points. Words are maximal runs of letters and digits; characters of scripts
written without spaces are words of their own. A word's hash comes from prefix sums, so nothing loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

#: Characters worked on at a time, so that a worker's memory stays small whatever a batch holds. A longer text is a chunk of its own.
CHUNK_CHARS = 600_000

_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(0, np.uint64), np.ones(0, np.uint64))


@lru_cache(1)
def char_classes() -> np.ndarray:
    """By code point: 0 neither, 1 letter or digit, 2 a word of its own (CJK), 3 digit."""
    c = np.zeros(0x110000, np.uint8)
    alnum = np.fromiter((chr(i).isalnum() for i in range(0x30000)), bool, 0x30000)
    c[:0x30000][alnum] = 1
    for a, b in ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FFFF)):
        c[a : b + 1][c[a : b + 1] == 1] = 2
    c[0x30:0x3A] = 3
    return c


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_CHARS + 4096)
        up, down = np.full(size, _P, np.uint64), np.full(size, _INV, np.uint64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


class Words:
    """The words of a chunk of texts. ``doc``: index of the text; ``h``: hash; ``start``/``end``: places in ``codes``."""

    def __init__(self, texts: Sequence[str]):
        self.n_docs = len(texts)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        self.offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
        self.codes = codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        cls = char_classes()[codes]
        run = (cls == 1) | (cls == 3)
        one = cls == 2
        before = np.concatenate(([False], run[:-1]))
        after = np.concatenate((run[1:], [False]))
        self.start = np.flatnonzero(one | (run & ~before))
        self.end = np.flatnonzero(one | (run & ~after)) + 1
        up, down = _power_tables(len(codes) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * up[: len(codes)], dtype=np.uint64)))
        self.h = mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.cls = cls

    def keep(self, which: np.ndarray) -> None:
        self.start, self.end, self.h, self.doc = self.start[which], self.end[which], self.h[which], self.doc[which]

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n consecutive words from each place; the last n - 1 places are left out."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k]
    return mix(out)


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of the texts whose characters together stay near CHUNK_CHARS."""
    lo = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > CHUNK_CHARS:
            yield lo, i
            lo, total = i, 0
        total += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def repeats(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Marks every place whose key occurred earlier in the same text."""
    k = mix(key + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(k, kind="stable")
    s = k[order]
    out = np.zeros(len(k), bool)
    out[order[1:]] = s[1:] == s[:-1]
    return out
