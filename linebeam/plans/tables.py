"""How each input of the original programs is derived from the test tables.

Every binding is a lazy DataFrame over the whole table; nothing is sampled,
capped or subset by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.functions.text import words
from linebeam.functions.xmlrow import xml_escape

# Fixed values of the bindings.
COMMENT_KEY_FACTOR = 11       # comments: user key = user_id * 11 (leaves unmatched keys on both sides)
REPUTATION_ABOVE = 1500       # reputable users: reputation > 1500 (strict)
SIGNUP_EVENT = "signup"       # comments of this type have no UserId
ERROR_EVENT = "error"         # '#' lines of this type have an empty second field
CLICK_EVENT = "click"         # '#' lines of this type end with a separator
POINT_RADIUS = 0.1            # circle radius for the point scan
MIN_YEAR = 1995               # first legal partition year
NUM_YEARS = 6                 # legal partition years: 1995..2000
YEAR_SALTS = 16               # parts a year is grouped in
ROWS_PER_FILE = 10_000        # rows of one file of a placed year, about
BLOOM_P = 0.01                # Bloom false-positive rate
CHECKED_FAMILY = "md5"        # hashes of the queries whose false positives are compared with SQL
DATE_OUT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The parquet table ``name`` (only ``cols`` when given)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id string, raw string, reputation int)."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal")
    return c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("raw"),
                    F.floor("c_acctbal").cast("int").alias("reputation"))


def reputable(users_df: DataFrame) -> DataFrame:
    """Users with reputation above the threshold, (id, raw)."""
    return users_df.where(F.col("reputation") > REPUTATION_ABOVE).select("id", "raw")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id string or NULL, raw string)."""
    e = table(spark, sf_dir, "events", "event_type", "user_id", "event_id")
    key = (F.col("user_id") * COMMENT_KEY_FACTOR).cast("string")
    return e.select(F.when(F.col("event_type") != SIGNUP_EVENT, key).alias("user_id"),
                    F.col("event_id").cast("string").alias("raw"))


def comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value string): one ``<row .../>`` line per event."""
    e = table(spark, sf_dir, "events", "event_id", "event_type", "props", "ts", "user_id")
    user = F.when(F.col("event_type") != SIGNUP_EVENT,
                  F.concat(F.lit(' UserId="'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.lit(""))
    line = F.concat(F.lit('  <row Id="'), F.col("event_id").cast("string"),
                    F.lit('" Note="see Text=" Text="'), xml_escape(F.concat_ws(" ", "event_type", "props")),
                    F.lit('" CreationDate="'), F.date_format("ts", DATE_OUT), F.lit('"'),
                    user, F.lit(" />"))
    return e.select(line.alias("value"))


def user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value string): one ``<row .../>`` line per order, dated by the order date."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_custkey")
    line = F.concat(F.lit('  <row Id="'), F.col("o_orderkey").cast("string"),
                    F.lit('" Note="at CreationDate=" CreationDate="'), F.date_format("o_orderdate", DATE_OUT),
                    F.lit('" OwnerId="'), F.col("o_custkey").cast("string"), F.lit('" />'))
    return o.select(line.alias("value"))


def word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id bigint, value string, file string): documents as word files."""
    d = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return d.select("doc_id", F.col("text").alias("value"), F.col("source").alias("file"))


def hot_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key string): the distinct words of the benchmark passages, as they stand there."""
    return words(table(spark, sf_dir, "benchmark", "text"), "text", "key").distinct()


def space_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(orderkey bigint, value string): the quantities of an order, blank
    separated; the order is the line."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity")
    return (li.groupBy(F.col("l_orderkey").alias("orderkey"))
            .agg(F.concat_ws(" ", F.collect_list(F.col("l_quantity").cast("int").cast("string"))).alias("value")))


def hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value string): ``event_id#user_id#floor(value)`` per event; the second
    field is empty for errors, clicks end with an extra separator."""
    e = table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "value")
    second = F.when(F.col("event_type") == ERROR_EVENT, F.lit("")).otherwise(F.col("user_id").cast("string"))
    tail = F.when(F.col("event_type") == CLICK_EVENT, F.lit("#")).otherwise(F.lit(""))
    line = F.concat(F.col("event_id").cast("string"), F.lit("#"), second, F.lit("#"),
                    F.floor("value").cast("string"), tail)
    return e.select(line.alias("value"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(x double, y double): the first two embedding components."""
    em = table(spark, sf_dir, "embeddings", "embedding")
    return em.select(F.col("embedding")[0].cast("double").alias("x"),
                     F.col("embedding")[1].cast("double").alias("y"))
