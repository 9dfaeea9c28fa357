"""Plan shapes: map-side combine, column pruning, Bloom lookup."""

import contextlib
import io

from pyspark.sql import functions as F

from linebeam.operators import bloom as bl
from linebeam.operators import index, wordcount

DOCS = "/root/testdata/sf0.01/documents.parquet"
EVENTS = "/root/testdata/sf0.01/events.parquet"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def main_plan(df) -> str:
    return plan(df).split("===== Subqueries =====")[0]


def test_partial_aggregate_before_shuffle(spark):
    docs = spark.read.parquet(DOCS).select(F.col("text").alias("value"))
    p = plan(wordcount.first_char_count(docs))
    assert "partial_count" in p
    assert p.index("Exchange") < p.index("partial_count")  # formatted plan lists top-down: final agg, exchange, partial


def test_column_pruning_reaches_scan(spark):
    docs = spark.read.parquet(DOCS)
    p = plan(index.posting_counts(docs.select(F.col("text").alias("value"), F.col("source").alias("file"))))
    assert "ReadSchema: struct<text:string,source:string>" in p


def test_filter_pushdown_reaches_scan(spark):
    ev = spark.read.parquet(EVENTS)
    p = plan(ev.where(F.col("event_type") != "signup").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,signup))]" in p


def test_bloom_semi_filter_shuffles_no_row(spark):
    """A small filter is broadcast; the rows are not shuffled, and each key is hashed once."""
    ev = spark.read.parquet(EVENTS).select(F.col("user_id").cast("string").alias("k"), "event_id")
    bf = bl.bloom_build(spark.range(10).select(F.col("id").cast("string").alias("key")), "key")
    p = main_plan(bl.bloom_semi_filter(ev, "k", bf))
    assert p.replace("BroadcastExchange", "").count("Exchange") == 0
    assert "NestedLoopJoin" not in p and "Cartesian" not in p
    tree = bl.bloom_semi_filter(ev, "k", bf)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("md5(") <= 2


def test_attribute_map_evaluated_once(spark):
    from linebeam.plans.queries import QUERIES
    tree = QUERIES["xml_attr_map"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("regexp_extract_all") == 1   # the line is matched once, for names and values


def test_outer_join_shuffles_each_side_once(spark):
    """Without broadcast, the full outer decomposition reuses the shuffle of
    each side's rows across its branches (only the distinct-key sides add)."""
    from linebeam.operators import joins
    from linebeam.plans import tables as T
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in old:
        spark.conf.set(k, "-1")
    try:
        d = "/root/testdata/sf0.001"
        df = joins.record_join(T.users(spark, d), T.comments(spark, d), "id", "user_id", "fullouter")
        df.collect()
        final = df._jdf.queryExecution().executedPlan().executedPlan().toString()
        assert final.count("SortMergeJoin") == 3
        assert final.count("ReusedExchange") == 2
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_year_expression_evaluated_once(spark):
    """The year of a row is computed once: no Filter repeats the date parse."""
    from linebeam.operators import partition
    lines = spark.createDataFrame([('<row Id="1" CreationDate="2010-01-01T00:00:00.000" />',)], "value string")
    p = main_plan(partition.users_by_year(lines))
    assert p.count("try_to_timestamp") == 1
    assert "Generate" in p
