"""Longest common subsequence of two line sequences."""

from __future__ import annotations

import numpy as np

CELLS = 4_000_000   # a larger table is halved (Hirschberg), so memory stays bounded


def _next(row, same):
    cand = row.copy()
    cand[1:] = np.maximum(row[1:], np.where(same, row[:-1] + 1, 0))
    return np.maximum.accumulate(cand)


def _lengths(a, b):
    """LCS lengths of the whole of ``a`` with each prefix of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row = _next(row, b == x)
    return row


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A mask over ``a``: its lines on one longest common subsequence with ``b``."""
    mask = np.zeros(len(a), bool)
    lo, n = 0, min(len(a), len(b))
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    mask[:lo] = True
    mask[len(a) - hi:] = True
    x, y = a[lo:len(a) - hi], b[lo:len(b) - hi]
    inner = mask[lo:len(a) - hi]
    live = np.isin(x, y)
    x, y = x[live], y[np.isin(y, x)]
    if len(x) and len(y):
        inner[np.flatnonzero(live)[_align(x, y)]] = True
    return mask


def _align(a, b):
    """Indices of ``a`` on a longest common subsequence with ``b``."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64)
    if len(a) == 1:
        return np.array([0]) if (b == a[0]).any() else np.empty(0, np.int64)
    if len(a) * len(b) > CELLS:
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return np.concatenate([_align(a[:half], b[:cut]), half + _align(a[half:], b[cut:])])
    table = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i, x in enumerate(a):
        table[i + 1] = _next(table[i], b == x)
    out, i, j = [], len(a), len(b)
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return np.array(out[::-1], np.int64)
