"""Rounds of online passes over sharded rows, their states averaged in between."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from linebeam.llm.common import Buckets, staged
from linebeam.llm.pieces import list_array, text_blocks
from linebeam.llm.shingles import WordHashes
from linebeam.llm.textfeatures import features

CHUNK = 1 << 16   # coordinates of a row of the state
STATE = pa.schema({"chunk": pa.int64(), "z": pa.binary(), "n": pa.binary()})
MOVED = pa.schema({"shard": pa.int64(), "chunk": pa.int64(), "z": pa.binary(), "n": pa.binary()})
MIN_ROWS = 4   # training rows that hold a feature, at least: the same at every sample size


def _featurise(shards, bits, extract, caches):
    """Feature numbers of the texts; a part of an Arrow batch at a time, so a worker holds few of its strings."""
    def run(batches):
        cache = caches()
        for b in batches:
            for part, texts in text_blocks(b, "text"):
                found = [extract(t, cache, bits).astype(np.int32) for t in texts]
                key = part.column("key").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(key % shards), part.column("key"), part.column("y"),
                                                  list_array(np.concatenate(found), [len(x) for x in found], pa.int32())],
                                                 names=["shard", "key", "y", "x"])
    return run


def _known(shared):
    """Feature numbers become coordinates; those not in use go."""
    def run(batches):
        kept = shared.value
        for b in batches:
            x = b.column("x")
            ends, flat = x.offsets.to_numpy().astype(np.int64), x.values.to_numpy()
            flat, starts = flat[ends[0]:ends[-1]], ends - ends[0]
            place = np.searchsorted(kept, flat).astype(np.int32)
            used = kept[np.minimum(place, len(kept) - 1)] == flat if len(kept) else np.zeros(len(flat), bool)
            before = np.concatenate([[0], np.cumsum(used)])
            yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("key"), pa.array(np.diff(starts), pa.int32()), b.column("y"),
                                              list_array(place[used], np.diff(before[starts]), pa.int32())],
                                             names=["shard", "key", "size", "y", "x"])
    return run


def _shard_row(frame):
    """A shard of the sample as one row, in key order: it is read again in every round, without a shuffle."""
    frame = frame.sort_values(["key", "size", "y"])
    rows = [np.asarray(x, np.int32) for x in frame["x"]]
    return pd.DataFrame({"shard": int(frame["shard"].iloc[0]), "y": [frame["y"].to_numpy(np.float64).tobytes()],
                         "sizes": [np.array([len(x) for x in rows], np.int32).tobytes()], "x": [np.concatenate(rows).tobytes()]})


def _first_state(features, extras):
    """Chunks of the state before the first round: zeros, and the extra coordinates' values."""
    def run(batches):
        for b in batches:
            for c in b.column(0).to_pylist():
                z, n = np.zeros((2, min(CHUNK, features + len(extras[0]) - c * CHUNK)), np.float32)
                at = np.arange(len(z)) + c * CHUNK - features
                z[at >= 0], n[at >= 0] = extras[0][at[at >= 0]], extras[1][at[at >= 0]]
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([z.tobytes()]), pa.array([n.tobytes()])], schema=STATE)
    return run


def _chunk(raw):
    return np.frombuffer(raw, np.float32)


def _shard_round(size, one_pass):
    """One shard's pass from the shared state: its state after it, in chunks."""
    def run(rows, chunks):
        if not rows.num_rows:
            return MOVED.empty_table()
        z, n = np.zeros(size), np.zeros(size)
        for c in chunks.to_pylist():
            at = slice(c["chunk"] * CHUNK, (c["chunk"] + 1) * CHUNK)
            z[at], n[at] = _chunk(c["z"]), _chunk(c["n"])
        r = rows.to_pylist()[0]
        ends = np.cumsum(np.frombuffer(r["sizes"], np.int32))
        x = np.frombuffer(r["x"], np.int32).astype(np.int64)
        one_pass(zip(np.split(x, ends[:-1]), np.frombuffer(r["y"])), z, n)
        z, n = z.astype(np.float32), n.astype(np.float32)
        starts = range(0, size, CHUNK)
        return pa.table([pa.array([r["shard"]] * len(starts), pa.int64()), pa.array([at // CHUNK for at in starts], pa.int64()),
                         pa.array([z[at:at + CHUNK].tobytes() for at in starts]), pa.array([n[at:at + CHUNK].tobytes() for at in starts])], schema=MOVED)
    return run


def _mean_steps(moved: pa.Table) -> pa.Table:
    """A chunk's next state: each coordinate moves by the mean step of the shards that touched it."""
    rows = sorted(moved.to_pylist(), key=lambda r: r["shard"])      # the shared state is shard -1
    z, n = (_chunk(rows[0][c]).astype(float) for c in "zn")
    dz, dn, touched = np.zeros(len(z)), np.zeros(len(z)), np.zeros(len(z))
    for r in rows[1:]:
        z1, n1 = _chunk(r["z"]), _chunk(r["n"])
        touched += n1 != n
        dz += z1 - z
        dn += n1 - n
    touched = np.maximum(touched, 1)
    z, n = (z + dz / touched).astype(np.float32), (n + dn / touched).astype(np.float32)
    return pa.table([pa.array([rows[0]["chunk"]], pa.int64()), pa.array([z.tobytes()]), pa.array([n.tobytes()])], schema=STATE)


def mixed_rounds(rows: DataFrame, bits: int, extra: int, shards: int, rounds: int, one_pass, how=(features, WordHashes), start=None):
    """(features, z, n) after ``rounds`` rounds over ``rows`` (key, y, text), a
    bounded sample: the sorted numbers of the features in use and the state of
    their coordinates, then of ``extra`` more. A row's shard is its key modulo
    ``shards``; in each round every shard runs ``one_pass(pairs of coordinates
    and y, z, n)`` from the shared state, in key order; a coordinate then moves
    by the mean step of the shards that touched it. The state is a table of
    chunks that goes to the shards and back to be averaged by chunk, so it is in
    no task but the shards' as a whole, and on the driver at the end only. Features that too few rows
    hold are left out: they could only memorise a row. ``how``: the feature
    function and what makes its cache; ``start``: (z, n) of the extra
    coordinates, given the mean y. No rows: no features, zeros."""
    spark = rows.sparkSession
    data = staged(rows.select("key", "y", "text").mapInArrow(_featurise(shards, bits, *how), "shard bigint, key bigint, y double, x array<int>"), "train")
    count, mean = data.agg(F.count("*"), F.avg("y")).first()
    common = data.select(F.explode("x").alias("x")).groupBy("x").agg(F.count("*").alias("rows")).where(F.col("rows") >= MIN_ROWS)
    # at most the sample's features / MIN_ROWS numbers
    kept = np.sort(np.concatenate([c.to_numpy() for c in common.select("x").toArrow().column("x").chunks] or [np.empty(0, np.int32)]))
    size = len(kept) + extra
    numbers = spark.sparkContext.broadcast(kept)
    data = (data.mapInArrow(_known(numbers), "shard bigint, key bigint, size int, y double, x array<int>")
            .repartition(shards, "shard").groupBy("shard").applyInPandas(_shard_row, "shard bigint, y binary, sizes binary, x binary"))
    held = Buckets(spark, "shard", 4 * shards, "shards")
    held.add(data)
    numbers.destroy()
    data = held.rows()
    held.forget()
    extras = (np.zeros(extra), np.zeros(extra)) if not (start and count) else [np.broadcast_to(v, extra).astype(float) for v in start(mean)]
    chunks = -(-size // CHUNK)
    state = staged(spark.range(0, chunks, 1, 1).mapInArrow(_first_state(len(kept), extras), from_arrow_schema(STATE)), "state")
    for _ in range(rounds if count else 0):
        sent = state.select("*", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"))
        ended = data.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(_shard_round(size, one_pass), from_arrow_schema(MOVED))
        moved = ended.unionByName(state.withColumn("shard", F.lit(-1).cast("bigint")))
        state = staged(moved.groupBy("chunk").applyInArrow(_mean_steps, from_arrow_schema(STATE)), "state")
    z, n = np.zeros(size), np.zeros(size)
    for r in state.toLocalIterator():                               # 8 bytes a coordinate, once
        at = slice(r["chunk"] * CHUNK, (r["chunk"] + 1) * CHUNK)
        z[at], n[at] = _chunk(r["z"]), _chunk(r["n"])
    return kept, z, n


class Weights:
    """Sparse weights by feature number, summed over a text's features."""

    def __init__(self, model, bits):
        self.at, self.w = model
        self.held = np.zeros(1 << bits, bool)
        self.held[self.at] = True

    def sum(self, x) -> float:
        x = x[self.held[x]]
        return float(self.w[np.searchsorted(self.at, x)].sum())
