"""The stateless operators over a file stream.

The original programs are bounded batch jobs; nothing here adds stream-only
semantics (no watermark, window or state). What carries over unchanged is the
row-wise work: the same column expressions and the Bloom-filter lookup apply to
``readStream`` sources, the filter being a static side of each micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linebeam.operators.bloom import BloomFilter, bloom_semi_filter


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming (value string) of the lines of files arriving under ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def semi_filter_stream(rows: DataFrame, key: str, bf: BloomFilter) -> DataFrame:
    """Streaming Bloom lookup: rows whose key may be a member."""
    return bloom_semi_filter(rows, key, bf)


def run_available(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "text"):
    """Process everything available now into ``out_path`` and stop; the
    checkpoint folder makes a rerun continue where the last one ended."""
    q = (df.writeStream.format(fmt).option("path", out_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
