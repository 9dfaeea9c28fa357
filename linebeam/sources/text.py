"""Text-line sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], line_sep: str | None = None,
               with_file: bool = False, min_partitions: int | None = None) -> DataFrame:
    """(value string[, file string]) for every line of every file under ``paths``.

    Lines break at ``\\n``, ``\\r`` and ``\\r\\n`` unless ``line_sep`` is given.
    ``.gz`` files are decompressed by suffix; such a file is one task, so
    ``min_partitions`` can spread the lines afterwards (round-robin, no key).
    ``with_file`` adds the base name of the source file.
    """
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = reader.text(paths)
    if with_file:
        df = df.select("value", F.col("_metadata.file_name").alias("file"))
    return df if min_partitions is None else df.repartition(min_partitions)



def read_named_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value string, file string) of every line that ``sinks.write_named_files``
    wrote below ``path``. The name comes from the folder's metadata, unescaped by
    the reader, and is a string whatever it looks like."""
    return spark.read.schema("value string, file string").text(path)
