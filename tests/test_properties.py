"""Properties: Bloom filter guarantees, join identities, round trips."""

import pytest
from pyspark.sql import functions as F

from linebeam import sinks
from linebeam.operators import bloom as bl
from linebeam.operators import bloomjoin, joins, wordcount
from linebeam.functions.text import tokens
from linebeam.plans import tables as T
from linebeam.sources import text

SF = "/root/testdata/sf0.001"


def test_bloom_size_formula():
    assert bl.bloom_size(1000, 0.01) == (9585, 7)
    assert bl.bloom_size(230, 0.01) == (2204, 7)
    with pytest.raises(ValueError):
        bl.bloom_size(10, 1.5)


def test_bloom_no_false_negative_and_fp_rate(spark):
    members = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    bf = bl.bloom_build(members, "key", p=0.01)
    assert (bf.m, bf.k, bf.n) == (*bl.bloom_size(5000, 0.01), 5000)
    assert bl.bloom_semi_filter(members, "key", bf).count() == 5000
    others = spark.range(50000).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("key"))
    fp = bl.bloom_semi_filter(others, "key", bf).count()
    assert fp <= 2 * 0.01 * 50000


def test_bloom_null_key_never_member(spark):
    bf = bl.bloom_build(spark.createDataFrame([("a",)], "key string"), "key")
    df = spark.createDataFrame([("a",), (None,)], "key string")
    assert [r["key"] for r in bl.bloom_semi_filter(df, "key", bf).collect()] == ["a"]


def test_bloom_blocks_lose_no_key_and_match_brute_force(spark):
    """Many small blocks: bits equal a plain rebuild, members pass, the rate holds."""
    import hashlib
    keys = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    bf = bl.bloom_build(keys, "key", p=0.01, block_bits=512)
    assert bf.blocks > 30
    want = set()
    for i in range(2000):
        d = hashlib.md5(str(i).encode()).hexdigest()
        h1, h2 = int(d[:15], 16), int(d[15:30], 16)
        for j in range(bf.k):
            want.add((h1 // 512 % bf.blocks, (h1 % 512 + j * (h2 % 512)) % 512))
    assert {(r["block"], r["q"]) for r in bl.bit_positions(bf).collect()} == want
    assert bl.bloom_semi_filter(keys, "key", bf).count() == 2000
    others = spark.range(20000).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("key"))
    assert bl.bloom_semi_filter(others, "key", bf).count() <= 0.04 * 20000


def test_bloom_rows_whatever_the_plan(spark):
    """exact=False gives the same rows with the filter broadcast or shuffled."""
    u, c = _users_comments(spark)
    a = T.reputable(u)
    def got():
        df = bloomjoin.bloom_join(a, c, "id", "user_id", "fullouter", exact=False, block_bits=256)
        return sorted(map(tuple, df.collect()))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    one = got()
    try:
        for k in names:
            spark.conf.set(k, "-1")
        assert got() == one
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bloom_of_no_keys(spark):
    none = spark.createDataFrame([(None,)], "key string")
    bf = bl.bloom_build(none, "key")
    assert bl.bloom_semi_filter(spark.createDataFrame([("a",), (None,)], "key string"), "key", bf).count() == 0


def test_bloom_save_load_round_trip(spark, stage):
    keys = spark.range(300).select(F.col("id").cast("string").alias("key"))
    bf = bl.bloom_build(keys, "key", block_bits=1024)
    path = stage("bf")
    bl.bloom_save(bf, path)
    back = bl.bloom_load(spark, path)
    assert (back.m, back.k, back.n, back.p, back.block_bits) == (bf.m, bf.k, bf.n, bf.p, bf.block_bits)
    assert sorted(map(tuple, back.table.collect())) == sorted(map(tuple, bf.table.collect()))


def _users_comments(spark):
    return T.users(spark, SF), T.comments(spark, SF)


def test_join_identities(spark):
    u, c = _users_comments(spark)
    n = {h: joins.record_join(u, c, "id", "user_id", h).count() for h in joins.JOIN_TYPES}
    assert n["fullouter"] == n["inner"] + n["anti"]
    assert n["leftouter"] + n["rightouter"] - n["inner"] == n["fullouter"]
    assert n["anti"] > 0 and n["inner"] > 0


def test_bloom_join_exact_forms(spark):
    u, c = _users_comments(spark)
    a = T.reputable(u)
    bf = bloomjoin.train_on(a, "id")
    def cnt(how, exact=True):
        return bloomjoin.bloom_join(a, c, "id", "user_id", how, bf=bf, exact=exact).count()
    assert cnt("rightouter") == cnt("inner") == joins.record_join(a, c, "id", "user_id", "inner").count()
    assert cnt("fullouter") == cnt("leftouter") == joins.record_join(a, c, "id", "user_id", "leftouter").count()
    # the approximate form may only add rows whose comment has no partner
    assert cnt("rightouter", exact=False) >= cnt("rightouter")
    leaked = bloomjoin.bloom_join(a, c, "id", "user_id", "anti", bf=bf, exact=False).where("user_raw = ''")
    assert leaked.join(a, leaked["comment_raw"] == a["raw"], "left_semi").count() == 0


def test_word_counts_sum_to_tokens(spark):
    lines = T.word_lines(spark, SF)
    total = wordcount.word_count(lines).agg(F.sum("n")).first()[0]
    assert total == lines.select(F.size(tokens("value")).alias("s")).agg(F.sum("s")).first()[0]


def test_sink_modes(spark, stage):
    path = stage("modes")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.write_tsv(df, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a\t1", "b\t2"]
    with pytest.raises(Exception):
        sinks.write_tsv(df, path)
    sinks.write_lines(df, "k", path, mode="overwrite")
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        sinks.write_lines(df, "k", path, mode="upsert")


def test_gzip_round_trip(spark, stage):
    path = stage("gz")
    df = spark.range(500).select(F.col("id").cast("string").alias("v"))
    sinks.write_lines(df, "v", path, compression="gzip")
    back = text.read_lines(spark, path, min_partitions=4)
    assert back.count() == 500
    assert sorted(int(r["value"]) for r in back.collect()) == list(range(500))


def test_line_breaks(spark, stage):
    from conftest import write_files
    folder = stage("lb")
    write_files(folder, {"a": "x\r\ny\rz\n\nlast"})
    assert [r["value"] for r in text.read_lines(spark, folder).collect()] == ["x", "y", "z", "", "last"]


def test_attributes_equal_a_plain_parser(spark):
    """Random lines with stray quotes, repeated names and odd blanks: the map and the single values."""
    import random
    import re

    from linebeam.functions import xmlrow
    rnd = random.Random(1)
    parts = ['a="1"', 'a = "2"', 'b=""', " ", 'c\t=\n"x y"', 'd="=q=z"', '"', "=", "<row", "/>", 'é="ü"', 'x=y="3"', 'a=\x0b"v"', "e='s'", 'f="&quot;"']
    rows = [("".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randrange(9))),) for _ in range(1500)]
    rows += [(None,), (" ".join(f'k{i % 700}="{i}"' for i in range(2000)),)]
    df = spark.createDataFrame(rows, "v string")
    plain = re.compile(xmlrow.ATTRIBUTE, re.A)
    for r in df.select("v", xmlrow.attr_map(F.col("v")).alias("m"), *[xmlrow.attr_value(F.col("v"), n).alias(n) for n in "abcd"]).collect():
        want = None if r["v"] is None else dict(plain.findall(r["v"]))
        assert r["m"] == want
        assert [r[n] for n in "abcd"] == [None if want is None else want.get(n) for n in "abcd"]
