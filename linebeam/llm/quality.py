"""Quality: ordinal cumulative-link regression over shared hashed-text weights.

P(grade <= j) = sigmoid(theta_j - w.x) with ordered thresholds theta: one weight
vector serves all grades. Training and its sample are those of the toxicity
model (bounded, dealt by an id hash, means between rounds); the weights take
FTRL steps, the thresholds their own adaptive steps, the gaps between them as
exponentials so their order holds. Features: words and pairs, and the shapes of
the white-space separated tokens (case, digits, marks) and pairs of shapes.

Scores: the expected grade, the tail probability P(grade >= ``least``), and the
selection by it. Cases as for toxicity; labels with null quality are not used.
No usable labels: expected grade 0, tail 0, nothing selected.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.rounds import Weights, mixed_rounds
from linebeam.llm.shingles import WordHashes, mix
from linebeam.llm.toxicity import ALPHA, BETA, HELD_OUT, TRAIN_ROWS, fold, sample, sigmoid, weights_of

BITS = 24
SHARDS, ROUNDS = 4, 4
L1 = 3.0
GRADES = 3       # poor, fair, good
LEAST = 1        # grade from which a document is worth keeping
KEEP = 0.5       # tail probability that keeps it

_RUNS = re.compile(r"([A-Z])[A-Z]*|([^\W\d_])[^\W\d_A-Z]*|(\d)\d*|(\W|_)\4*")
_PAIR, _SHAPE, _SHAPES = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


class _Shapes(WordHashes):
    """token -> hash of its shape: runs of capitals, letters, digits and equal marks."""

    def __missing__(self, token):
        shape = _RUNS.sub(lambda m: "A" if m[1] else "a" if m[2] else "0" if m[3] else m[4], token)
        return super().__missing__(token) if shape == token else self.setdefault(token, self[shape])


def quality_features(text: str | None, cache: tuple, bits: int) -> np.ndarray:
    """Distinct feature numbers of the whole text; null or blank: none."""
    tokens = text.split() if text else []
    if not tokens:
        return np.empty(0, np.int64)
    words, shapes = cache
    w = np.fromiter(map(words.__getitem__, [t.lower() for t in tokens]), np.uint64, len(tokens))
    s = np.fromiter(map(shapes.__getitem__, tokens), np.uint64, len(tokens))
    turn = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        kinds = [mix(w), mix(w[:-1] * turn + w[1:] + _PAIR), mix(s + _SHAPE), mix(s[:-1] * turn + s[1:] + _SHAPES)]
        return np.unique(np.concatenate(kinds) >> np.uint64(64 - bits)).view(np.int64)


def caches():
    return WordHashes(), _Shapes()


def thresholds(state) -> np.ndarray:
    """theta from the first threshold and the logarithms of the gaps."""
    return np.concatenate([state[:1], state[0] + np.cumsum(np.exp(np.clip(state[1:], -10, 10)))])


def ordinal_pass(rows, z, n):
    """One pass over (features, grade); the last GRADES - 1 coordinates hold the thresholds' state."""
    cuts = slice(len(z) - (GRADES - 1), len(z))
    for x, y in rows:
        y = int(y)
        w = weights_of(z[x], n[x], ALPHA, BETA, L1, 0.0)
        s = w.sum()
        theta = thresholds(z[cuts])
        above = sigmoid(theta[y] - s) if y < GRADES - 1 else 1.0
        below = sigmoid(theta[y - 1] - s) if y else 0.0
        p = max(above - below, 1e-9)
        g = 1.0 - above - below                                   # of the loss, by the score
        sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / ALPHA
        z[x] += g - sigma * w
        n[x] += g * g
        by = np.zeros(GRADES - 1)                                 # of the loss, by each threshold
        if y < GRADES - 1:
            by[y] -= above * (1 - above) / p
        if y:
            by[y - 1] += below * (1 - below) / p
        gaps = np.exp(np.clip(z[cuts][1:], -10, 10))
        step = np.concatenate([[by.sum()], np.cumsum(by[::-1])[::-1][1:] * gaps])
        n[cuts] += step * step
        z[cuts] -= 0.3 * step / (1.0 + np.sqrt(n[cuts]))


def train(docs: DataFrame, labels: DataFrame, grade: str, rows: int = TRAIN_ROWS):
    """(feature numbers, weights, thresholds); thresholds None without usable labels."""
    kept, z, n = mixed_rounds(sample(docs, labels, grade, rows), BITS, GRADES - 1, SHARDS, ROUNDS, ordinal_pass, (quality_features, caches))
    w = weights_of(z[:len(kept)], n[:len(kept)], ALPHA, BETA, L1, 0.0)
    return kept[w != 0], w[w != 0], thresholds(z[len(kept):]) if n.any() else None


def _scorer(shared, theta, keep, least, cut):
    def run(frames):
        weights, cache = Weights(shared.value, BITS), caches()
        for f in frames:
            if theta is None:
                tails = np.zeros((len(f), GRADES - 1))
            else:
                s = np.array([weights.sum(quality_features(t, cache, BITS)) for t in f["__text"]], float)
                tails = 1 - sigmoid(theta[None, :] - s[:, None])
            yield f[list(keep)].assign(expected_grade=tails.sum(axis=1), tail=tails[:, least - 1], keep=tails[:, least - 1] >= cut)
    return run


def score(docs: DataFrame, model, keep, text: str = "text", least: int = LEAST, cut: float = KEEP) -> DataFrame:
    """Columns ``keep``, expected_grade, tail = P(grade >= least), keep."""
    at, weights, theta = model
    shared = docs.sparkSession.sparkContext.broadcast((at, weights))   # the sample's weights
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return (docs.select(*keep, F.col(text).alias("__text"))
            .mapInPandas(_scorer(shared, theta, keep, least, cut), f"{head}, expected_grade double, tail double, keep boolean"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail, keep) per row of ``docs``. Grades
    from the labels: 0 for poor quality, else 1 for toxic and 2 for clean text."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
    ids = docs.select("doc_id", "text", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"))
    return score(ids, train(docs, labels.select("doc_id", grade.alias("grade")), "grade"), ["doc_id", "held_out"])
