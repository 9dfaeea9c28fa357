"""Bloom filter as Spark expressions: sizing, distributed build, storage,
membership test.

Layout: one row ``(block int, bits array<bigint>)`` per block of the filter.
A filter of up to ``block_bits`` bits is one block of exactly m bits; a larger
one has ceil(m / block_bits) blocks of block_bits bits. A key lives in one
block, so a lookup is an equi-join on the block number and k ``getbit`` tests.
The filter's size is measured before a plan is built: below the session's
broadcast bound it is sent to every task, above it Spark shuffles it; there is no
cap. Where it fits, ``might_contain`` also tests keys inside a scan.

Hashing: two numbers below 2^60 a key (so nothing overflows under ANSI). With w
the bits of a block, ``block = (h1 div w) mod blocks`` and ``q_i = (h1 mod w + i *
(h2 mod w)) mod w``. Two families give h1 and h2:

* ``md5`` (default): the first and second 15 hex digits. md5 is known to other SQL
  engines, so such a filter can be rebuilt and checked bit for bit;
* ``xxhash64``: the 64-bit hash under two seeds, the low 60 bits. No strings are
  made and cut, so a lookup costs a fraction; the joins use it, whose rows don't
  depend on the hash.

Build: keys -> k positions each -> ``bit_or`` per 64-bit word (combined before
the shuffle), with a zero row for every word -> one sorted array per block, at
most block_bits / 64 words. It is linear in the number of keys, and written once
to the shared folder, so its size is known to every plan that probes it. Two
numbers (the distinct key count, and nothing else) come to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.operators.sidetable import broadcast_bound, stored_bytes
from linebeam.session import scratch_dir

FAMILIES = ("xxhash64", "md5")
SEEDS = (1, 2)             # hashed before the key: two members of the xxhash64 family
HASH_BITS = (1 << 60) - 1
BLOCK_BITS = 1 << 20   # 128 KB a block
FILTER = "block int, bits array<bigint>"


def bloom_size(n: int, p: float) -> tuple[int, int]:
    """(m, k) for n keys at false-positive rate p:
    m = floor(-n ln p / (ln 2)^2), k = round(m / n * ln 2); at least 1 each."""
    if not 0.0 < p < 1.0:
        raise ValueError("p must be in (0, 1)")
    n = max(int(n), 1)
    m = max(int(math.floor(-n * math.log(p) / (math.log(2) ** 2))), 1)
    k = max(int(math.floor(m / n * math.log(2) + 0.5)), 1)
    return m, k


@dataclass
class BloomFilter:
    m: int
    k: int
    n: int
    p: float
    block_bits: int
    family: str
    table: DataFrame   # one row per block: block, bits
    bytes: int = 0     # of its files

    @property
    def blocks(self) -> int:
        return -(-self.m // self.block_bits)

    @property
    def width(self) -> int:
        """Bits of a block."""
        return min(self.m, self.block_bits)

    @property
    def fits(self) -> bool:
        """Whether all its bits may be sent to every task."""
        return max(self.bytes, self.blocks * _words(self.width) * 8) <= broadcast_bound(self.table.sparkSession)


def hash_pair(key: Column, family: str) -> tuple[Column, Column]:
    """h1 and h2 of a string key; -1 for NULL."""
    if family == "md5":
        d = F.md5(key)
        return tuple(F.coalesce(F.conv(F.substring(d, at, 15), 16, 10).cast("bigint"), F.lit(-1)) for at in (1, 16))
    return tuple(F.when(key.isNull(), F.lit(-1).cast("bigint")).otherwise(F.xxhash64(F.lit(seed), key).bitwiseAND(F.lit(HASH_BITS))) for seed in SEEDS)


def hashed(df: DataFrame, key: Column, bf: BloomFilter) -> DataFrame:
    """``df`` with the key's ``_block`` and its ``_a``, ``_b`` (first position and step), each computed once."""
    width, blocks = bf.width, bf.blocks
    h1, h2 = hash_pair(key.cast("string"), bf.family)
    # none of the columns is nullable (a NULL key is in block -1), so no inferred
    # null filter repeats the hash below the projection
    with_h = df.withColumns({"_h1": h1, "_h2": h2})
    block = F.expr(f"cast((_h1 div {width}) % {blocks} as int)") if blocks > 1 else F.lit(0)
    return (with_h.withColumns({"_block": F.coalesce(F.when(F.col("_h1") < 0, F.lit(-1)).otherwise(block), F.lit(-1)),
                                "_a": F.coalesce(F.col("_h1") % width, F.lit(0)), "_b": F.coalesce(F.col("_h2") % width, F.lit(0))})
            .drop("_h1", "_h2"))


def positions(width: int, k: int) -> list[Column]:
    """The k bit positions of a ``hashed`` row."""
    return [(F.col("_a") + F.lit(i) * F.col("_b")) % F.lit(width) for i in range(k)]


def _words(bits: int) -> int:
    return (bits + 63) // 64


def bloom_build(keys: DataFrame, key: str, n: int | None = None, p: float = 0.01,
                block_bits: int = BLOCK_BITS, family: str = "md5") -> BloomFilter:
    """Train a filter on the non-NULL values of ``keys[key]``; ``n`` defaults to
    the number of distinct keys (one count job). Duplicates are harmless; no
    key gives an empty filter."""
    if family not in FAMILIES:
        raise ValueError(f"family must be one of {FAMILIES}")
    spark = keys.sparkSession
    members = keys.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull())
    if n is None:
        n = members.distinct().count()
    m, k = bloom_size(n, p)
    bf = BloomFilter(m, k, int(n), float(p), block_bits, family, None)
    words = _words(bf.width)
    pos = (hashed(members, F.col("key"), bf)
           .select("_block", F.explode(F.array(*positions(bf.width, k))).alias("q"))
           .select(F.col("_block").alias("block"), F.shiftright("q", 6).cast("int").alias("w"),
                   F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("q").bitwiseAND(63).cast("int")).alias("b")))
    zeros = spark.range(bf.blocks * words).select(F.expr(f"id div {words}").cast("int").alias("block"),
                                                  (F.col("id") % words).cast("int").alias("w"), F.lit(0).cast("bigint").alias("b"))
    per_word = pos.unionByName(zeros).groupBy("block", "w").agg(F.bit_or("b").alias("b"))
    rows = (per_word.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("x"))
            .select("block", F.transform("x", lambda e: e["b"]).alias("bits")))
    path = scratch_dir(spark, "bloom")
    rows.write.parquet(path)
    bf.table, bf.bytes = spark.read.schema(FILTER).parquet(path), stored_bytes(spark, path)
    return bf


def bloom_save(bf: BloomFilter, path: str, mode: str = "errorifexists") -> None:
    """Write the filter with its numbers as Parquet."""
    head = {"m": F.lit(bf.m).cast("bigint"), "k": F.lit(bf.k), "n": F.lit(bf.n).cast("bigint"),
            "p": F.lit(bf.p), "block_bits": F.lit(bf.block_bits), "family": F.lit(bf.family)}
    bf.table.withColumns(head).write.mode(mode).parquet(path)


def bloom_load(spark: SparkSession, path: str) -> BloomFilter:
    """Read a filter written by ``bloom_save``; the bits stay in Spark."""
    rows = spark.read.parquet(path)
    head = rows.select("m", "k", "n", "p", "block_bits", "family").first()
    return BloomFilter(int(head["m"]), int(head["k"]), int(head["n"]), float(head["p"]), int(head["block_bits"]),
                       head["family"], rows.select("block", "bits"), stored_bytes(spark, path))


def bit_positions(bf: BloomFilter) -> DataFrame:
    """(block int, q bigint) of every set bit."""
    words = bf.table.select("block", F.posexplode("bits").alias("w", "b")).where("b <> 0")
    at = words.select("block", "w", "b", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
    return at.where(F.getbit("b", F.col("i")) == 1).select("block", (F.col("w").cast("bigint") * 64 + F.col("i")).alias("q"))


def bloom_semi_filter(df: DataFrame, key: str, bf: BloomFilter) -> DataFrame:
    """Rows of ``df`` whose key may be a member: a superset of the exact
    semi-join; NULL keys are no members. The key is hashed once per row; the
    filter has one row per block, so no row is repeated. A filter that fits is
    broadcast, so the rows aren't shuffled."""
    probe = hashed(df, F.col(key), bf)
    side = bf.table.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    found = probe.join(F.broadcast(side) if bf.fits else side, "_block")
    for q in positions(bf.width, bf.k):
        word = F.element_at("_bits", (F.shiftright(q, 6) + 1).cast("int"))
        found = found.where(F.getbit(word, q.bitwiseAND(63).cast("int")) == 1)
    return found.select(*df.columns)


def bits_in_scan(bf: BloomFilter) -> Column:
    """The blocks of a filter that fits, as one scalar subquery (array<array<bigint>>)."""
    row = (bf.table.agg(F.sort_array(F.collect_list(F.struct("block", "bits"))).alias("x"))
           .select(F.transform("x", lambda e: e["bits"]).alias("blocks")))
    return row.scalar()


def might_contain(bits: Column, key: Column, bf: BloomFilter) -> Column:
    """Whether ``key`` may be a member, tested where the row is: no join and no
    shuffle. ``bits``: a column made of ``bits_in_scan(bf)``; NULL is no member."""
    def test(h):
        block = F.get(bits, F.expr("0") if bf.blocks == 1 else (F.call_function("div", h["a"], F.lit(bf.width).cast("bigint")) % F.lit(bf.blocks)).cast("int"))
        hit = h["a"] >= 0
        for i in range(bf.k):
            q = (h["a"] % bf.width + F.lit(i) * (h["b"] % bf.width)) % F.lit(bf.width)
            hit = hit & (F.getbit(F.get(block, F.shiftright(q, 6).cast("int")), q.bitwiseAND(63).cast("int")) == 1)
        return hit
    h1, h2 = hash_pair(key, bf.family)
    return F.exists(F.array(F.struct(h1.alias("a"), h2.alias("b"))), test)   # binds the two hashes once a key
