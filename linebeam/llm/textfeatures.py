"""Hashed word n-grams and skip-grams of a text, as sorted distinct feature numbers."""

from __future__ import annotations

import re

import numpy as np

from linebeam.llm.shingles import WordHashes, mix

_WORDS = re.compile(r"\w+").findall
# odd constants that keep the kinds of features apart
_PREVIOUS, _PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(text: str | None, cache: WordHashes, bits: int) -> np.ndarray:
    """Unigrams, bigrams and pairs with one word skipped, over the whole text;
    each counts once. Null or wordless text: none."""
    words = _WORDS(text.lower()) if text else []
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        pair = mix(h[:-1] * _PREVIOUS + h[1:] + _PAIR)
        skip = mix(h[:-2] * _PREVIOUS + h[2:] + _SKIP)
        return np.unique(np.concatenate([mix(h), pair, skip]) >> np.uint64(64 - bits)).view(np.int64)
