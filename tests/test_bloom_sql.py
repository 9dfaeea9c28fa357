"""The SQL of the approximate queries rebuilds filters of many blocks bit for bit."""

import duckdb
import pytest

from linebeam.operators import bloom as bl
from linebeam.plans.oracle import BLOCK_BITS, FILTER_BITS, bloom_ctes, bloom_hits


def test_default_block():
    assert BLOCK_BITS == bl.BLOCK_BITS


@pytest.mark.parametrize("n,block_bits", [(3000, 512), (3000, 4096), (150_000, BLOCK_BITS), (1, 512)])
def test_bits_and_hits_over_blocks(spark, n, block_bits):
    keys = spark.range(n).selectExpr("cast(id * 7 as string) as key")
    bf = bl.bloom_build(keys, "key", n=n, p=0.01, block_bits=block_bits)
    con = duckdb.connect()
    members = f"SELECT CAST(range * 7 AS VARCHAR) AS key FROM range({n})"
    with_filter = f"WITH {bloom_ctes(members, block_bits)} "
    want = con.execute(f"{with_filter} SELECT n, m, k, block, q FROM ({FILTER_BITS}) ORDER BY block, q").fetchall()
    assert want[0][:3] == (n, bf.m, bf.k) and (want[-1][3] > 0) == (bf.blocks > 1)
    got = bl.bit_positions(bf).orderBy("block", "q").toPandas()
    assert [w[3:] for w in want] == list(zip(got["block"].tolist(), got["q"].tolist()))
    probe = "SELECT CAST(range AS VARCHAR) AS key FROM range(20000)"
    hits = {r[0] for r in con.execute(f"{with_filter} {bloom_hits(probe)}").fetchall()}
    passed = bl.bloom_semi_filter(spark.range(20000).selectExpr("cast(id as string) as key"), "key", bf)
    assert {r["key"] for r in passed.collect()} == hits
