"""Exact top-k inner products over quantised vectors, norm-sorted and pruned.

Vectors become integers floor(scale * x) and are range-partitioned by descending
length into blocks. Queries, packed into blocks too, first meet the blocks of
the longest vectors, which gives each a score it must reach. Then every query
block meets the vector blocks whose longest vector can still reach it
(Cauchy-Schwarz): query blocks go to the vector block, which is sent once for a
group of them; inside a pair of blocks, partial sums over the leading
coordinates of an SVD rotation plus the product of the residual lengths bound
each score, at two depths, and only survivors are multiplied out, in integers.
Floating point only prunes, with a margin; scores and ties are exact.

Cases: vectors that are null, or hold null or non-finite components, and rows
without an id take no part. Rows that repeat an id count once (the smallest
vector). Shorter vectors count as padded with zeros; empty ones score 0. Fewer
candidates than k: all of them. An empty table, or no queries: no rows. Extra
columns are not read. Quantised components and scores beyond 64 bits count as the
largest or smallest 64-bit number of their sign, ties again to the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from linebeam.llm.common import ranked, staged

BLOCK_ROWS = 8192     # vectors of a block
QUERY_ROWS = 128      # queries of a block
GROUP_BLOCKS = 64     # query blocks that go to a vector block together, about
HEAD_BLOCKS = 2       # blocks of the longest vectors that give the first thresholds
STRIP = 1024          # vectors compared at once
WIDEST = 2 ** 63 - 1
DEPTHS = (0.5, 0.75)  # share of the rotated coordinates in the partial sums

VECTORS = "vec_id bigint, v array<bigint>, norm double"
BLOCKS = "block bigint, rows int, longest double, ids binary, matrix binary"
FOUND = pa.schema({"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()})


def _held(x: int) -> int:
    """The nearest number of 64 bits."""
    return max(-WIDEST, min(WIDEST, x))


def _quantised(x: float, scale) -> int:
    x *= scale
    return _held(math.floor(x)) if math.isfinite(x) else WIDEST if x > 0 else -WIDEST


def _quantise(scale):
    def run(batches):
        for b in batches:
            ids, out, norms = [], [], []
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if i is None or x is None or any(c is None or not math.isfinite(c) for c in x):
                    continue
                q = [_quantised(float(c), scale) for c in x]
                ids.append(i)
                out.append(q)
                norms.append(math.sqrt(sum(c * c for c in q)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64())), pa.array(norms, pa.float64())],
                                             names=["vec_id", "v", "norm"])
    return run


def _matrix(arrays, dims):
    m = np.zeros((len(arrays), dims), np.int64)
    for r, x in enumerate(arrays):
        m[r, :len(x)] = x
    return m


def _gram(dims):
    """Partial sums of v v^T, one row of the matrix per output row."""
    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            m = _matrix(b.column(0).to_pylist(), dims).astype(float)
            total += m.T @ m
        at = np.indices((dims, dims)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(total.ravel())], names=["i", "j", "s"])
    return run


def _pack(dims, rows):
    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                s = b.slice(lo, rows)
                m = _matrix(s.column(1).to_pylist(), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip(
                        [part << 32 | n, len(m), max(s.column(2).to_pylist()), np.array(s.column(0).to_pylist(), np.int64).tobytes(), m.tobytes()],
                        [pa.int64(), pa.int32(), pa.float64(), pa.binary(), pa.binary()])],
                    names=["block", "rows", "longest", "ids", "matrix"])
                n += 1
    return run


class _Side:
    """A block's ids, integer rows, rotated rows, lengths, and residual lengths at each depth."""

    def __init__(self, ids, matrix, rotation):
        dims = len(rotation)
        self.ids = np.frombuffer(ids, np.int64)
        self.ints = np.frombuffer(matrix, np.int64).reshape(len(self.ids), dims)
        self.rotated = self.ints.astype(float) @ rotation
        squares = np.cumsum(self.rotated[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.norm = np.sqrt(squares[:, 0]) if dims else np.zeros(len(self.ids))
        self.depths = [max(1, int(dims * d)) for d in DEPTHS] if dims else []
        self.rest = [np.sqrt(squares[:, d]) if d < dims else np.zeros(len(self.ids)) for d in self.depths]


def _best(q, i, s, k):
    """Of scored pairs (query row, id, score) the k best of each query."""
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    first = np.concatenate([[True], q[1:] != q[:-1]]) if len(q) else np.empty(0, bool)
    at = np.arange(len(q))
    keep = at - np.maximum.accumulate(np.where(first, at, 0)) < k if len(q) else first
    return q[keep], i[keep], s[keep]


def _scores(a, b):
    if not a.shape[1]:
        return np.zeros(len(a), np.int64)
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2 ** 62:
        return np.einsum("ij,ij->i", a, b)
    return np.array([_held(sum(int(x) * int(y) for x, y in zip(r, s))) for r, s in zip(a, b)], np.int64)


def compare(queries: _Side, vectors: _Side, least: np.ndarray, k: int):
    """(query rows, ids, scores): the k best of each query among ``vectors`` that reach ``least``."""
    got = []
    least = least.astype(float)
    top = float(vectors.norm.max(initial=0))
    slack = 1e-9 * (1 + queries.norm * top)
    for lo in range(0, len(vectors.ids), STRIP):
        hi = lo + STRIP
        reach = queries.norm * float(vectors.norm[lo:hi].max()) + slack >= least
        rows = np.flatnonzero(reach)
        if not len(rows):
            continue
        q, v = np.repeat(rows, len(vectors.ids[lo:hi])), np.tile(np.arange(lo, min(hi, len(vectors.ids))), len(rows))
        for n, d in enumerate(queries.depths):
            if n == 0:
                bound = queries.rotated[rows, :d] @ vectors.rotated[lo:hi, :d].T + np.outer(queries.rest[n][rows], vectors.rest[n][lo:hi])
                ok = np.flatnonzero((bound + slack[rows, None] >= least[rows, None]).ravel())
            else:
                bound = np.einsum("ij,ij->i", queries.rotated[q, :d], vectors.rotated[v, :d]) + queries.rest[n][q] * vectors.rest[n][v]
                ok = np.flatnonzero(bound + slack[q] >= least[q])
            q, v = q[ok], v[ok]
        ok = queries.ids[q] != vectors.ids[v]
        q, v = q[ok], v[ok]
        got.append(_best(q, vectors.ids[v], _scores(queries.ints[q], vectors.ints[v]), k))
    if not got:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return _best(*(np.concatenate(x) for x in zip(*got)), k)


def _first_thresholds(shared, k):
    """Each query block with the score every query must reach: its k-th best among the longest vectors."""
    def run(batches):
        rotation, head = shared.value
        sides = [_Side(i, m, rotation) for i, m in head]
        for b in batches:
            for r in b.to_pylist():
                side = _Side(r["ids"], r["matrix"], rotation)
                never = np.full(len(side.ids), -np.inf)
                parts = [compare(side, h, never, k) for h in sides]
                q, _, s = _best(*(np.concatenate(x) for x in zip(*parts)), k)
                least = never.copy()
                full = np.bincount(q, minlength=len(least)) == k
                low = np.full(len(least), np.iinfo(np.int64).max)
                np.minimum.at(low, q, s)
                least[full] = low[full]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], t) for x, t in zip(
                        [r["block"], r["longest"], float(least.min()), r["ids"], r["matrix"], least.tobytes()],
                        [pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()])],
                    names=["qblock", "qlongest", "lowest", "qids", "qmatrix", "least"])
    return run


def _pair_pass(shared, k):
    """A vector block against the query blocks it meets."""
    def run(block, asked):
        if not block.num_rows or not asked.num_rows:
            return FOUND.empty_table()
        rotation = shared.value[0]
        vectors, got = _Side(block["ids"][0].as_py(), block["matrix"][0].as_py(), rotation), []
        for n in range(asked.num_rows):
            queries = _Side(asked["qids"][n].as_py(), asked["qmatrix"][n].as_py(), rotation)
            q, i, s = compare(queries, vectors, np.frombuffer(asked["least"][n].as_py()), k)
            got.append((queries.ids[q], i, s))
        return pa.table([pa.array(np.concatenate(x), pa.int64()) for x in zip(*got)], schema=FOUND)
    return run


def top_inner_products(vectors: DataFrame, is_query, *, vec_id: str = "vec_id", embedding: str = "embedding",
                       k: int = 10, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row with ``is_query`` (a
    condition on ``vec_id``) its k highest integer inner products with the other rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    rows = rows.mapInArrow(_quantise(scale), VECTORS).groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("m"))
    rows = staged(rows.select("vec_id", "m.v", "m.norm"), "vectors")
    total, asked, dims = rows.agg(F.count("*"), F.count_if(is_query), F.max(F.size("v"))).first()
    dims = dims or 0
    gram = np.zeros((dims, dims))
    if dims:
        cells = rows.select("v").mapInArrow(_gram(dims), "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
        for c in cells.collect():                                    # dims * dims numbers
            gram[c["i"], c["j"]] = c["s"]
    rotation = np.linalg.eigh(gram)[1][:, ::-1].copy() if dims else gram   # right singular vectors of the data, longest first

    count = max(1, -(-total // BLOCK_ROWS))
    blocks = staged(rows.repartitionByRange(count, F.desc("norm"), F.col("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id")
                    .mapInArrow(_pack(dims, BLOCK_ROWS), BLOCKS), "blocks")
    wanted = rows.where(is_query).repartition(max(1, -(-asked // QUERY_ROWS)), "vec_id")
    head = [(r["ids"], r["matrix"]) for r in blocks.orderBy(F.desc("longest"), "block").limit(HEAD_BLOCKS).collect()]  # HEAD_BLOCKS blocks
    shared = spark.sparkContext.broadcast((rotation, head))
    queries = staged(wanted.mapInArrow(_pack(dims, QUERY_ROWS), BLOCKS).mapInArrow(
        _first_thresholds(shared, k), "qblock bigint, qlongest double, lowest double, qids binary, qmatrix binary, least binary"), "queries")

    # which blocks meet: numbers only, one row per block of queries and block of vectors that can still matter
    numbers = staged(ranked(blocks.select("block", "longest"), "block"), "numbers")
    each = F.explode(F.sequence(F.lit(0), F.lit(max(0, numbers.count() - 1)).cast("bigint")))
    # the queries that a block meets go to it in groups of bounded size; the block is sent once a group
    groups = F.lit(max(1, -(-asked // (QUERY_ROWS * GROUP_BLOCKS))))
    pairs = staged(queries.select("qblock", "qlongest", "lowest", each.alias("rank")).join(numbers, "rank")
                   .where(F.col("qlongest") * F.col("longest") * (1 + 1e-9) + 1e-9 >= F.col("lowest"))
                   .select("qblock", "block", F.pmod(F.xxhash64("qblock"), groups).alias("group")), "pairs")
    sent = (pairs.join(queries.select("qblock", "qids", "qmatrix", "least"), "qblock")
            .select(F.col("block").alias("to"), F.col("group").alias("part"), "qids", "qmatrix", "least").groupBy("to", "part"))
    held = pairs.select("block", "group").distinct().join(blocks.select("block", "ids", "matrix"), "block").groupBy("block", "group")
    found = held.cogroup(sent).applyInArrow(_pair_pass(shared, k), from_arrow_schema(FOUND))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def duckdb_top(k: int = 10, scale: int = 1024, every: int = 100) -> str:
    """The query as DuckDB SQL, for vectors of one length."""
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS x FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
          FROM v q, v WHERE q.vec_id % {every} = 0 AND q.vec_id <> v.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= {k}"""
