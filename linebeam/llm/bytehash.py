"""64-bit hashes of many byte ranges of a block, by array operations."""

from __future__ import annotations

import numpy as np

from linebeam.llm.shingles import mix

_P = 0x9E3779B97F4A7C15                       # odd, so it has an inverse modulo 2^64
_STEP = np.uint64(_P), np.uint64(pow(_P, -1, 1 << 64))


class Powers:
    """Powers of the multiplier and of its inverse, as many as the longest block needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n):
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up, self.down = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, x)])) for x in _STEP)
        return self.up, self.down


def hashes_of(block, first, last, powers: Powers):
    """The hash of each range first..last (inclusive) of the bytes in ``block``."""
    up, down = powers.get(len(block) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(block * up[:len(block)], dtype=np.uint64)])
        return mix((total[last + 1] - total[first]) * down[first] + (last + 1 - first).astype(np.uint64))
