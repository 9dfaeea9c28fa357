"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table below the shared checkpoint folder and
    read it back: the lineage is cut, and a lost executor loses nothing. The
    shuffle files of the write aren't needed any more and go with its end."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with _shuffles_freed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_freed(spark):
    """Spark deletes the shuffle files of what is executed inside as each execution ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


BIT_TABLE = 1 << 23   # bits of a bit table: 1 MB whatever the data


def bit_of(col):
    """The place of a 64-bit value in a bit table."""
    return F.pmod(col, F.lit(BIT_TABLE)).cast("int")


def bit_table(values: DataFrame, col: str):
    """A broadcast bit table of the 64-bit hashes in ``col``: of fixed size, so
    it may always be sent; a fuller table only lets more rows pass to the exact
    join that follows."""
    words = (values.select(bit_of(F.col(col)).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits")).collect())  # BIT_TABLE / 64 rows at most
    table = np.zeros(BIT_TABLE // 64, np.int64)
    for w in words:
        table[w["word"]] = w["bits"]
    return values.sparkSession.sparkContext.broadcast(table.tobytes())


def in_table(table: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which signed 64-bit hashes the table may hold."""
    at = hashes.astype(np.int64) % BIT_TABLE
    return (np.frombuffer(table, np.uint64)[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank``, its place in the global order: a distributed sort,
    places inside each partition, and one count per partition on the driver."""
    spark = rows.sparkSession
    placed = staged(rows.orderBy(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mid")), "ranked")
    starts, total = [], 0
    for r in sorted(placed.groupBy("part").count().collect()):   # one row per partition
        starts.append((r["part"], total))
        total += r["count"]
    base = spark.createDataFrame(starts, "part int, base bigint")
    return placed.join(base, "part").select(*rows.columns, (F.col("base") + F.col("mid").bitwiseAND((1 << 33) - 1)).alias("rank"))


def unused(name: str, columns) -> str:
    """``name``, lengthened until no column is called so (Spark ignores case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


class Buckets:
    """Rows in the shared folder in ``buckets`` buckets of ``key``: grouping by the key
    moves none of them. Only the catalog can say that files are bucketed, so they
    are a table until ``forget``, which drops the entry and leaves the files and the
    frames made before."""

    def __init__(self, spark: SparkSession, key: str, buckets: int, name: str):
        self.spark, self.key, self.buckets = spark, key, buckets
        self.path, self.table = scratch_dir(spark, name), f"{name}_{uuid.uuid4().hex}"

    def add(self, df: DataFrame) -> None:
        with _shuffles_freed(self.spark):
            (df.write.mode("append").bucketBy(self.buckets, self.key).option("path", self.path)
             .option("compression", "zstd").saveAsTable(self.table))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def forget(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
