"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training reads a bounded sample of labelled documents (``TRAIN_ROWS``), chosen
by a hash of the id. It is dealt into a fixed number of shards by that hash, so
the model doesn't depend on Spark's partitions. In each round every shard runs
one FTRL pass, in hash order, from the shared state; the mean steps give the
next round's state. Per-coordinate rates come from the squared-gradient sums, and
the L1 term leaves few weights, which are all that scoring broadcasts.

Scoring is one pass over the whole table with no shuffle.

Cases: null or empty texts have no features: their score is that of the bias.
Labels that are null, or of documents absent from the table, are not used; a
document labelled twice counts by its largest label; rows repeated in the table
train as often as they stand there, as far as they are labelled. No usable
labels: every score is 0. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.rounds import Weights, mixed_rounds
from linebeam.llm.shingles import WordHashes
from linebeam.llm.textfeatures import features

BITS = 24            # features are numbered up to 2^24
TRAIN_ROWS = 24_000  # labelled documents used, at most about so many
# Rounds, rates, L1 and offset were chosen by cross-validation inside the folds that
# training may use (README); the held-out fold had no part in it.
SHARDS, ROUNDS = 4, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.0
OFFSET = 0.9         # added to the log odds: L1 holds back what few rows speak for, such as a rarer language's words
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2   # crc32(doc_id as text) mod 4 = 2 is never trained on


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def weights_of(z, n, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
    """FTRL's closed form: zero within the L1 band, else a step at the coordinate's own rate."""
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def ftrl_pass(rows, z, n):
    """One pass over (features, label) pairs; ``z`` and ``n`` are updated in place. The last coordinate is the bias."""
    bias = len(z) - 1
    for x, y in rows:
        x = np.append(x, bias)
        w = weights_of(z[x], n[x])
        w[-1] = -z[bias] / ((BETA + np.sqrt(n[bias])) / ALPHA)      # the bias has no penalty
        g = sigmoid(w.sum()) - y
        sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / ALPHA
        z[x] += g - sigma * w
        n[x] += g * g


def base_rate(share):
    """(z, n) of a bias that gives the share of positive rows, so that common words need not learn it."""
    share = min(max(share, 0.001), 0.999)
    return -np.log(share / (1 - share)) * (BETA + 1.0) / ALPHA, 1.0


def fold(doc_id):
    """crc32 of the id as text, modulo the folds; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(key, y, text): about ``rows`` labelled training documents at most, by id hash.

    The labels side is at most about ``rows`` pairs of numbers, so it may be broadcast."""
    usable = (labels.where(F.col(label).isNotNull() & (fold("doc_id") != HELD_OUT))
              .groupBy("doc_id").agg(F.max(label).cast("double").alias("y")))
    total = usable.count()
    key = F.xxhash64("doc_id")
    share = F.lit(2 ** 32 if total <= rows else int(2 ** 32 * rows / total))
    chosen = usable.where(F.pmod(key, F.lit(2 ** 32)) < share).select("doc_id", "y")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(key.alias("key"), "y", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS):
    """(feature numbers, weights, bias): the sparse model."""
    kept, z, n = mixed_rounds(sample(docs, labels, label, rows), BITS, 1, SHARDS, ROUNDS, ftrl_pass, start=base_rate)
    w = weights_of(z[:-1], n[:-1])
    bias = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA) + OFFSET if n[-1] else -np.inf
    return kept[w != 0], w[w != 0], float(bias)


def _scorer(shared, bias, keep, text, threshold):
    def run(frames):
        weights, cache = Weights(shared.value, BITS), WordHashes()
        for f in frames:
            s = [float(sigmoid(weights.sum(features(t, cache, BITS)) + bias)) if bias > -np.inf else 0.0 for t in f[text]]
            yield f[list(keep)].assign(score=s, predicted=[int(x >= threshold) for x in s])
    return run


def score(docs: DataFrame, model, keep, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Columns ``keep``, score (0 to 1) and predicted (score >= threshold)."""
    at, w, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((at, w))   # the sample's weights
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return (docs.select(*dict.fromkeys([*keep, text]))
            .mapInPandas(_scorer(shared, bias, keep, text, threshold), f"{head}, score double, predicted int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model, trained on them, doesn't reject, with all their columns."""
    at, w, bias = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((at, w))

    def run(batches):
        weights, cache, cut = Weights(shared.value, BITS), WordHashes(), np.log(THRESHOLD / (1 - THRESHOLD))
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                keep = [weights.sum(features(t, cache, BITS)) + bias < cut for t in part.column("text").to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``; a null doc_id is not held out."""
    ids = docs.select("doc_id", "text", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"))
    return score(ids, train(docs, labels), ["doc_id", "held_out"])
