"""Word-shingle sets as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORD_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)   # odd constant of the polynomial over word hashes
CACHE_WORDS = 400_000


class WordHashes(dict):
    """word -> 64-bit hash, computed once per word; emptied when it grows large."""

    def __missing__(self, word):
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ with A-Z lowered: bytes.lower and bytes.split
    know ASCII letters and exactly these six white-space bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(text: str | None, cache: WordHashes, width: int = 5) -> np.ndarray:
    """The distinct shingles as sorted signed 64-bit hashes; fewer words than
    ``width``: the whole sequence as one; no words: empty."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    acc = np.full(len(words) - n + 1, n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            acc = acc * WORD_MULTIPLIER + h[i:len(words) - n + 1 + i]
            acc ^= acc >> np.uint64(29)
        return np.unique(mix(acc).view(np.int64))
