"""One key holds a third of all rows: AQE splits it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from linebeam.operators import joins, wordcount

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _data(spark, n=30000):
    users = spark.range(1000).select(F.col("id").cast("string").alias("id"),
                                     F.concat(F.lit("u"), F.col("id").cast("string")).alias("raw"))
    # a third of all comments belong to user 7; the rest spread over 2000 ids
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000)
    comments = spark.range(n).select(key.cast("string").alias("uid"), F.col("id").cast("string").alias("raw"))
    return users, comments


def _final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query execution, so AQE finalises its plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "leftouter", "rightouter", "fullouter"])
def test_hot_key_is_split_and_rows_are_whole(spark, skew_conf, how):
    users, comments = _data(spark)
    out = joins.record_join(users, comments, "id", "uid", how)
    plan = _final_plan(out)
    assert "skew=true" in plan
    expected = {"inner": 15000, "leftouter": 15000 + 0, "rightouter": 30000, "fullouter": 30000}[how]
    # users 0..999 match comment keys 0..999 (hot key 7 included); keys 1000..1999 have no user
    inner = comments.where(F.col("uid").cast("int") < 1000).count()
    unmatched_users = users.join(comments, users["id"] == comments["uid"], "left_anti").count()
    expected = {"inner": inner, "leftouter": inner + unmatched_users,
                "rightouter": 30000, "fullouter": 30000 + unmatched_users}[how]
    assert out.count() == expected


def test_hot_word_collapses_before_shuffle(spark):
    lines = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("the")).otherwise(F.concat(F.lit("w"), F.col("id").cast("string")))
        .alias("value"))
    counts = wordcount.word_count(lines)
    assert counts.where("word = 'the'").first()["n"] == 10000
    assert counts.count() == 20001
