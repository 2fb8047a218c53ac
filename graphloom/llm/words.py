"""Words of many texts at once, with hashes of all their windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from graphloom.llm.common import ASCII_LOWER, text_bytes

#: Bytes of words: digits, lower-case letters, and all bytes beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True
#: All bytes but ASCII white space.
UNSPACED = np.ones(256, bool)
UNSPACED[0x09:0x0E] = UNSPACED[0x20] = False
_LOWER = np.frombuffer(ASCII_LOWER, np.uint8)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers with all their bits spread over all places."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so that they have an inverse modulo 2^64


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ``base`` and of its inverse modulo 2^64."""

    def run(b: int) -> np.ndarray:
        steps = np.full(n, b, np.uint64)
        steps[:1] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return run(base), run(pow(base, -1, 1 << 64))


class Powers:
    """Powers for arrays of growing length."""

    def __init__(self, base: int):
        self.base, self.of, self.inverse = base, *_powers(base, 1)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.of):
            self.of, self.inverse = _powers(self.base, max(n, 1 << 16))
        return self.of, self.inverse


_BYTES, _WORDS = Powers(_BASE), Powers(_STEP)


class Words:
    """The words of some texts: where they start and end, which text has them, and hashes of windows."""

    def __init__(self, column: pa.Array, kind: np.ndarray):
        data, bounds = text_bytes(column)
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = kind[self.data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside[:-1]
        before[bounds] = False  # words don't go on in the next text
        starts = inside & ~before
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside[1:]
        after[bounds[1:] - 1] = False
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.text = np.searchsorted(bounds, self.starts, side="right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(column) + 1))
        self.bounds = bounds
        of, inverse = _BYTES.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * of[: len(data)], out=sums[1:], dtype=np.uint64)
        words = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        words = mixed(words)
        of, self._inverse = _WORDS.upto(len(words) + 1)
        self._sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * of[: len(words)], out=self._sums[1:], dtype=np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of ``size`` words within one text."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        firsts = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        hashes = (self._sums[firsts + size] - self._sums[firsts]) * self._inverse[firsts]
        return firsts, mixed(hashes + np.uint64(size))

    def joined(self, first: int, size: int) -> bytes:
        chosen = slice(first, first + size)
        return b" ".join([self.data[s:e].tobytes() for s, e in zip(self.starts[chosen], self.ends[chosen])])
