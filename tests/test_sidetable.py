"""Broadcast by measured bytes, and the map-only hot-list lookup that rests on it."""

import random

import pytest
from pyspark.sql import functions as F

from linebeam.operators import bloom as bl
from linebeam.operators import hotlist
from linebeam.operators.sidetable import ROW_FACTOR, broadcast_bound, hash_set, stage_side, stored_bytes
from tests.test_plans import main_plan, plan

BOUND = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def bound(spark):
    old = spark.conf.get(BOUND)
    yield lambda v: spark.conf.set(BOUND, v)
    spark.conf.set(BOUND, old)


def exchanges(df) -> int:
    return main_plan(df).replace("BroadcastExchange", "").replace("ReusedExchange", "").count("Exchange")


def test_measured_bytes_decide(spark, bound):
    side = stage_side(spark.range(50_000).select(F.md5(F.col("id").cast("string")).alias("key")))
    assert side.bytes == stored_bytes(spark, side.path) > 50_000 * 32
    bound(str(side.bytes * ROW_FACTOR))
    assert side.fits() and "ResolvedHint" in side.joinable()._jdf.queryExecution().analyzed().toString()
    bound(str(side.bytes * ROW_FACTOR - 1))
    assert not side.fits() and "Hint" not in side.joinable()._jdf.queryExecution().analyzed().toString()
    assert not side.fits(side.bytes * ROW_FACTOR) and side.fits(side.bytes)
    bound("-1")
    assert not side.fits()
    bound("10MB")
    assert broadcast_bound(spark) == 10 << 20


def records(spark, n=400, seed=5):
    rnd = random.Random(seed)
    parts = ["hot", "hot.", "ho't", "cold", "Hot", "x9y", "'", "", "ice", "key"]
    rows = [(rnd.choice([i, None, 7]), " ".join(rnd.choices(parts[3:] if i % 2 else parts, k=rnd.randrange(6)))) for i in range(n)]
    return spark.createDataFrame([*rows, (1, None), (2, ""), (3, "hot\x0bhot"), (4, "x " * 30000 + "hot"), (5, "zz")] * 2, "id int, text string")


def expected(rows, hot, strip, lower):
    import re
    out = []
    for i, t in rows:
        keys = [re.sub("[^a-zA-Z]", " ", w.replace("'", "")) for w in re.split("[ \t\n\r\f]+", t or "")]
        keys = [k.strip(" ") if strip else k for k in keys]
        if any(k and (k.lower() if lower else k) in hot for k in keys):
            out.append((i, t))
    return sorted(out, key=str)


@pytest.mark.parametrize("strip,lower", [(False, False), (True, True)])
@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_both_plans_give_the_same_rows(spark, bound, strip, lower, limit):
    recs, hot = records(spark), {"hot", "key", "x y"}
    keys = spark.createDataFrame([(k,) for k in [*hot, "hot", None]], "key string")
    want = expected([tuple(r) for r in recs.collect()], hot, strip, lower)
    bound(limit)
    exact = hotlist.hotlist_filter(recs, "text", keys, strip=strip, lower=lower)
    loose = hotlist.hotlist_filter(recs, "text", keys, strip=strip, lower=lower, approximate=True, p=1e-6)
    assert sorted(map(tuple, exact.collect()), key=str) == want == sorted(map(tuple, loose.collect()), key=str)
    for df in (exact, loose):
        assert (exchanges(df) == 0) == (limit != "-1") and df.columns == ["id", "text"]


def test_lookup_is_map_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    hot = spark.createDataFrame([("the",), ("of",)], "key string")
    for approximate in (True, False):
        p = plan(hotlist.hotlist_filter(docs, "text", hot, approximate=approximate))
        above, subquery = p.split("===== Subqueries =====")
        assert "Exchange" not in above and "Join" not in above and "Python" not in above
        assert "Subquery" in subquery


def test_approximate_lookup_of_both_plans_agrees_over_many_blocks(spark, bound):
    """Several filter blocks: the bits tested in the scan are the ones that the join tests."""
    keys = spark.range(3000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    probe = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key")).union(spark.createDataFrame([(None,)], "key string"))
    for family in bl.FAMILIES:
        bf = bl.bloom_build(keys, "key", p=0.05, block_bits=1024, family=family)
        assert bf.blocks > 10
        joined = {r[0] for r in bl.bloom_semi_filter(probe, "key", bf).collect()}
        scanned = probe.withColumn("bits", bl.bits_in_scan(bf)).where(bl.might_contain(F.col("bits"), F.col("key"), bf))
        assert {r[0] for r in scanned.collect()} == joined
        assert {f"k{i}" for i in range(3000)} <= joined and None not in joined


def test_hash_set_is_exact(spark):
    keys = [f"k{i}" for i in range(1000)] + ["", " ", "é", "k\u0000"]
    side = stage_side(spark.createDataFrame([(k,) for k in keys], "key string"))
    found = hash_set(side, "key", len(keys))
    probe = spark.createDataFrame([(k,) for k in [*keys, "K1", "k1000", None, "e"]], "w string").withColumn("b", found.row)
    assert {r["w"] for r in probe.where(found.contains(F.col("b"), F.col("w"))).collect()} == set(keys)
    none = hash_set(stage_side(spark.createDataFrame([], "key string")), "key", 0)
    assert probe.drop("b").withColumn("b", none.row).where(none.contains(F.col("b"), F.col("w"))).count() == 0


@pytest.mark.parametrize("p", [0.1, 0.01])
def test_false_positives_follow_p(spark, p):
    """Members always pass; of 100,000 others about p do, within five standard deviations (and the
    loss of double hashing in blocks), in both hash families."""
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    others = spark.range(1_000_000, 1_100_000).select(F.col("id").cast("string").alias("key"))
    for family in bl.FAMILIES:
        bf = bl.bloom_build(keys, "key", p=p, family=family)
        assert bl.bloom_semi_filter(keys, "key", bf).count() == 20_000
        passed = bl.bloom_semi_filter(others, "key", bf).count()
        assert abs(passed - p * 100_000) < 5 * (p * 100_000) ** 0.5 + 0.1 * p * 100_000


def test_family_is_saved_and_checked(spark, stage):
    bf = bl.bloom_build(spark.createDataFrame([("a",)], "key string"), "key", family="md5")
    path = stage("bloom")
    bl.bloom_save(bf, path)
    back = bl.bloom_load(spark, path)
    assert back.family == "md5" and back.bytes > 0
    assert bl.bloom_semi_filter(spark.createDataFrame([("a",)], "key string"), "key", back).count() == 1
    with pytest.raises(ValueError):
        bl.bloom_build(spark.createDataFrame([("a",)], "key string"), "key", family="crc32")
