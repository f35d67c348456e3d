"""Vectorised words and word hashes of a slice of documents (numpy)."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads their bits (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    x = np.full(n, base, np.uint64)
    x[:1] = 1
    return np.multiply.accumulate(x)


class Slice:
    """Words of consecutive documents.

    ``starts``/``ends``: byte range of each word in ``blob``; ``doc``: the
    document's number; ``first``/``count``: each document's first word and how
    many it has; ``hashes``: a 64-bit hash of each word.
    """

    def __init__(self, texts: list[bytes], table: bytes):
        """``table`` maps bytes; those that become a blank (32) separate words."""
        self.blob = b" ".join(texts).translate(table)
        raw = np.frombuffer(self.blob, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes + 1)))
        inside = np.concatenate(([0], (raw != 32).view(np.int8), [0]))
        step = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        # the joining blanks keep words of two documents apart
        self.doc = np.searchsorted(begins, self.starts, "right") - 1
        self.first = np.searchsorted(self.starts, begins[:-1])
        self.count = np.diff(np.concatenate((self.first, [len(self.starts)])))
        terms = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(raw)), out=terms[1:])
        own = (terms[self.ends] - terms[self.starts]) * _powers(BASE_INVERSE, len(raw) + 1)[self.starts]
        self.hashes = mix(own)

    def words(self, begin: int, end: int) -> list[bytes]:
        """The words numbered ``begin`` to ``end`` (exclusive) of the slice."""
        if begin >= end:
            return []
        return self.blob[self.starts[begin]:self.ends[end - 1]].split()

    def grams(self, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``(word number, hash)`` of every run of k words of a document.

        With ``short``, a document of fewer words, but not none, has one run of them all.
        """
        n = len(self.hashes)
        left = np.repeat(self.first + self.count, self.count) - np.arange(n)  # words to the document's end
        padded = np.concatenate((self.hashes, np.zeros(k, np.uint64)))
        total = np.zeros(n, np.uint64)
        factor = 1
        for j in range(k):
            factor = factor * 0xD1342543DE82EF95 + 1 & MASK
            part = padded[j:j + n] * np.uint64(factor | 1)
            total += np.where(left > j, part, np.uint64(0)) if short else part
        at = left >= k
        if short:
            starts = self.first[(self.count > 0) & (self.count < k)]
            at[starts] = True
        at = np.flatnonzero(at)
        return at, mix(total[at])
