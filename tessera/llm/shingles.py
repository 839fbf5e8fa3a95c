"""Word-shingle sets of whole texts as 64-bit hashes, computed with array arithmetic inside tasks."""

from __future__ import annotations

import numpy as np

WIDTH = 5
_rng = np.random.default_rng(20240501)
LETTER = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Hash sets of the distinct ``WIDTH``-word shingles of a text (A-Z lower-cased, words split at ASCII
    white space; fewer words: the whole sequence is the one shingle; no words: the empty set).

    A shingle's hash is a polynomial over the bytes between its first and last word, taken from prefix
    sums of the whole text, so it costs the same for any length of words."""

    def __init__(self, width: int = WIDTH):
        self.width = width
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        power = lambda b: np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]))
        self.up, self.down = power(BASE), power(pow(BASE, -1, 1 << 64))

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        b = np.frombuffer(b" ".join(words), np.uint8)
        if len(b) > len(self.up):
            self._grow(2 * len(b))
        sums = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(LETTER[b] * self.up[: len(b)], out=sums[1:])
        blank = np.flatnonzero(b == 32)
        k = min(self.width, len(words))
        start = np.concatenate([[0], blank + 1])[: len(words) - k + 1]
        end = np.concatenate([blank, [len(b)]])[k - 1 :]
        h = (sums[end] - sums[start]) * self.down[start]
        h ^= h >> np.uint64(32)
        h *= MIX
        h ^= h >> np.uint64(29)
        return np.unique(h)
