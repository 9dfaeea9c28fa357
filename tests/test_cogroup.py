"""The one-shuffle co-group join: same rows as the assembled join, one exchange, hot keys split."""

import random

import pytest
from pyspark.sql import functions as F

from linebeam.operators import cogroup
from linebeam.operators.joins import JOIN_TYPES, record_join
from tests.test_plans import main_plan


def sides(spark, n=300, seed=3):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["hot", "", None, "01", "1", f"k{rnd.randrange(80)}"])
    a = [(key(), rnd.choice([None, "", f"a{i}", "same"])) for i in range(n)] + [("only a", "x")] * 20
    b = [(key(), rnd.choice([None, "", f"b{i}", "same"])) for i in range(n)] + [("only b", "y")] * 20
    return (spark.createDataFrame(a, "id string, raw string").repartition(3), spark.createDataFrame(b, "user string, raw string").repartition(3))


def plain(a, b, how):
    """The join by dictionaries of bags."""
    bags = {}
    for side, rows in enumerate((a, b)):
        for k, r in rows:
            if k is not None:
                bags.setdefault(k, ([], []))[side].append(r)
    out = []
    for x, y in bags.values():
        if x and y:
            out += [(i, j) for i in x for j in y] if how != "anti" else []
        elif x and how in ("leftouter", "fullouter", "anti"):
            out += [(i, "") for i in x]
        elif y and how in ("rightouter", "fullouter", "anti"):
            out += [("", j) for j in y]
    return sorted(out, key=str)


@pytest.mark.parametrize("how", JOIN_TYPES)
@pytest.mark.parametrize("bag_rows", [1, 7, 2048])
def test_same_rows(spark, how, bag_rows):
    a, b = sides(spark)
    got = cogroup.cogroup_join(a, b, "id", "user", how, bag_rows=bag_rows)
    want = plain(a.collect(), b.collect(), how)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert sorted(map(tuple, record_join(a, b, "id", "user", how).collect()), key=str) == want


@pytest.mark.parametrize("how", JOIN_TYPES)
def test_empty_sides(spark, how):
    a, b = sides(spark, 20)
    for x, y in ((a, b.limit(0)), (a.limit(0), b), (a.limit(0), b.limit(0))):
        got = cogroup.cogroup_join(x, y, "id", "user", how.upper())
        assert sorted(map(tuple, got.collect()), key=str) == plain(x.collect(), y.collect(), how)
    with pytest.raises(ValueError):
        cogroup.cogroup_join(a, b, "id", "user", "cross")


@pytest.mark.parametrize("how", ["fullouter", "anti"])
def test_one_exchange_of_the_union(spark, how):
    a, b = sides(spark)
    p = main_plan(cogroup.cogroup_join(a, b, "id", "user", how))
    assert p.count("hashpartitioning") == 1 and "SortMergeJoin" not in p
    assert "Union" in p and p.index("hashpartitioning") > 0


def test_key_with_a_third_of_the_rows_is_split(spark):
    """No cell holds more than a few times ``bag_rows`` records of a side, copies of one record included."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    a = spark.range(30_000).select(key.alias("k"), F.lit("same").alias("raw"))
    b = spark.range(3_000).select(key.alias("k"), F.col("id").cast("string").alias("raw"))
    cells = cogroup.bags(a, b, "k", "k", bag_rows=200)
    assert cells.where("key = 'hot'").count() == 50 * 5
    assert cells.agg(F.max(F.greatest(F.size("as"), F.size("bs")))).first()[0] < 400
    assert cogroup.cogroup_join(a, b, "k", "k", "fullouter", bag_rows=200).count() == 10_000 * 1_000 + 20_000


def test_hot_list_is_measured(spark):
    a, b = sides(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cogroup.cogroup_join(a, b, "id", "user", "fullouter", bag_rows=5)
        assert "Broadcast" not in main_plan(got)
        assert sorted(map(tuple, got.collect()), key=str) == plain(a.collect(), b.collect(), "fullouter")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
