"""Partial inverted index: which files each (lower-cased) word occurs in.

Plan shape: explode tokens -> distinct (word, file) with a partial aggregate
before the shuffle -> group by word. The posting list of a word is bounded by
the number of distinct files, not by the number of occurrences; the long form
``posting_counts`` has no per-row bound at all and is the one to use when the
file count is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.functions.text import words

# A printed posting list is "{ " + names joined by " " + " }".
LIST_OPEN = "{ "
LIST_CLOSE = " }"

BUCKETS = 16   # rows a word's file list is split over


def word_file_pairs(lines: DataFrame, text: str = "value", file: str = "file", buckets: int = 1) -> DataFrame:
    """(word, file[, bucket]) per token occurrence, word lower-cased; the bucket
    is made once a line, not once a word."""
    keep = {"file": F.col(file), **({"bucket": _bucket(file, buckets)} if buckets > 1 else {})}
    pairs = words(lines.select(F.col(text).alias("_text"), *[c.alias(n) for n, c in keep.items()]), "_text", "word", keep=tuple(keep))
    return pairs.select(F.lower("word").alias("word"), *keep)


def posting_counts(lines: DataFrame, text: str = "value", file: str = "file") -> DataFrame:
    """(word string, file string, tf bigint): occurrences of a word in a file."""
    return (word_file_pairs(lines, text, file)
            .groupBy("word", "file").agg(F.count(F.lit(1)).alias("tf")))


def _bucket(file: str, buckets: int):
    """A file's bucket: the first four hex digits of its name's md5, so that SQL engines agree."""
    return F.conv(F.substring(F.md5(file), 1, 4), 16, 10).cast("int") % buckets


def posting_maps(lines: DataFrame, text: str = "value", file: str = "file", buckets: int = BUCKETS) -> DataFrame:
    """(word string, bucket int, tf map<string,bigint>): occurrences of each word by
    file, names ascending; ``buckets=1`` is one row per word, without the bucket column.

    Counts are combined before the shuffle, so a map is made of one entry per file,
    not of one per occurrence; as in ``inverted_index`` a word's files are split over
    ``buckets`` rows, so no row has more than about files/buckets entries.
    """
    pairs = word_file_pairs(lines, text, file, buckets)
    counts = pairs.groupBy(*pairs.columns).agg(F.count(F.lit(1)).alias("tf"))
    entries = F.sort_array(F.collect_list(F.struct("file", "tf")))
    by = [c for c in pairs.columns if c != "file"]
    return counts.groupBy(*by).agg(F.map_from_entries(entries).alias("tf"))


def posting_maps_report(maps: DataFrame) -> DataFrame:
    """``maps`` with the map printed as ``{f0=2, f1=1}``."""
    printed = F.transform(F.map_entries("tf"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.withColumn("tf", F.concat(F.lit("{"), F.array_join(printed, ", "), F.lit("}")))


def inverted_index(lines: DataFrame, text: str = "value", file: str = "file", buckets: int = BUCKETS) -> DataFrame:
    """(word string, bucket int, files string): the distinct files of each
    word, in ascending byte order, joined by one blank.

    The file set of a word is split over up to ``buckets`` rows by a hash of
    the file name (the first four hex digits of its md5), so a word found in
    every file is assembled by ``buckets`` tasks and no row grows beyond about
    files/buckets names. Every file is listed; ``buckets=1`` is one row per
    word, without the bucket column.
    """
    pairs = word_file_pairs(lines, text, file, buckets).distinct()
    return (pairs.groupBy(*[c for c in pairs.columns if c != "file"])
            .agg(F.array_join(F.sort_array(F.collect_list("file")), " ").alias("files")))


def inverted_index_report(index: DataFrame) -> DataFrame:
    """``index`` with the posting list printed as ``{ f0 f1 }``."""
    return index.withColumn("files", F.concat(F.lit(LIST_OPEN), F.col("files"), F.lit(LIST_CLOSE)))


def sort_by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Whole output ascending by key in byte order (range-partitioned sort,
    no single-task bottleneck)."""
    return df.orderBy(*(keys or ("word",)))
