"""Side tables: small relations that go to every task, if they are small.

A side table is staged below the shared folder, and its size is read from the file
system before a plan is built. Whether it is broadcast is then decided by that
measured size against the session's ``spark.sql.autoBroadcastJoinThreshold``, the
bound a user of Spark already sets for it; ``-1`` there means never. The files are
written without compression, and rows take up to ``ROW_FACTOR`` times their bytes
in memory, so the factor is part of the comparison.

``HashSet`` is an exact key set that a scan can test by itself: one row holding an
array of buckets, read as a scalar subquery. A lookup takes one bucket by the key's
hash and compares the few keys in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.session import scratch_dir

ROW_FACTOR = 4        # bytes in memory per byte of the staged files, at most about
BUCKET_KEYS = 2       # keys a bucket holds on average


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, from the file system's own summary."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def broadcast_bound(spark: SparkSession) -> int:
    """Bytes that the session lets a plan broadcast; negative: none."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    if raw.lstrip("-").isdigit():
        return int(raw)
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw))


@dataclass
class SideTable:
    path: str
    rows: DataFrame
    bytes: int        # of its files

    def fits(self, needed: int | None = None) -> bool:
        """Whether it may be sent to every task; ``needed`` replaces the estimate of its bytes in memory."""
        return (self.bytes * ROW_FACTOR if needed is None else needed) <= broadcast_bound(self.rows.sparkSession)

    def joinable(self) -> DataFrame:
        """Its rows, marked for broadcast where they fit; else Spark chooses a shuffled join."""
        return F.broadcast(self.rows) if self.fits() else self.rows


def stage_side(df: DataFrame, name: str = "side") -> SideTable:
    """Write ``df`` below the shared folder and measure it."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", "none").parquet(path)
    return SideTable(path, spark.read.schema(df.schema).parquet(path), stored_bytes(spark, path))


@dataclass
class HashSet:
    row: Column    # array<array<string>>: the buckets, as a scalar subquery; to be a column of the rows that are tested
    size: int

    def contains(self, buckets: Column, key: Column) -> Column:
        bucket = F.get(buckets, F.pmod(F.xxhash64(key), F.lit(self.size)).cast("int"))
        return F.coalesce(F.array_contains(bucket, key), F.lit(False))


def hash_set(side: SideTable, key: str, n: int) -> HashSet:
    """The set of the ``n`` distinct keys of ``side``, which must fit: it is built in one task."""
    size = max(1, n // BUCKET_KEYS)
    filled = side.rows.groupBy(F.pmod(F.xxhash64(key), F.lit(size)).alias("b")).agg(F.collect_list(key).alias("keys"))
    every = side.rows.sparkSession.range(size).select(F.col("id").alias("b")).join(F.broadcast(filled), "b", "left")
    row = (every.agg(F.sort_array(F.collect_list(F.struct("b", "keys"))).alias("x"))
           .select(F.transform("x", lambda e: e["keys"]).alias("buckets")))
    return HashSet(row.scalar(), size)
