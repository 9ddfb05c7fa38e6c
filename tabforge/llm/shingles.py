"""Word shingles as 64-bit hashes, for tasks that work on Arrow batches."""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.array([(2 * i + 1) * 0x9E3779B97F4A7C15 % 2**64 | 1 for i in range(1, 65)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Distinct hashed shingles of ``k`` words.

    Lower-casing and splitting work on the UTF-8 bytes, which touches A-Z and
    the six ASCII white-space characters only. Word hashes are remembered up to
    ``remember`` words and then forgotten, so memory is bounded.
    """

    def __init__(self, k: int = 5, remember: int = 60_000):
        self.k, self.remember, self.known = k, remember, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > self.remember:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.array([known[w] for w in words], dtype=np.uint64)
        k = min(self.k, len(h))
        n = len(h) - k + 1
        total = np.full(n, k, np.uint64)
        for i in range(k):
            total = mixed(total + h[i : i + n] * _ODD[i])
        return np.unique(total)
