"""Token counts: first letters and words.

Plan shape: scan -> Generate(explode) -> partial HashAggregate -> Exchange ->
final HashAggregate. The partial aggregate is the map-side combine, so a hot
word costs one row per task before the shuffle, whatever its frequency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.functions.text import first_letter, words


def first_char_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """(letter string, n bigint): words per lower-cased initial letter;
    words that do not start with a letter are skipped.

    First characters are counted as they stand; whether one is a letter, and its
    lower case, is settled once per distinct character, not once per word."""
    initials = words(lines, text).select(F.substring("w", 1, 1).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    return (initials.select(first_letter(F.col("c")).alias("letter"), "n").where(F.col("letter").isNotNull())
            .groupBy("letter").agg(F.sum("n").alias("n")))


def word_count(lines: DataFrame, text: str = "value", case: str = "lower") -> DataFrame:
    """(word string, n bigint) over the tokens of ``text``.

    ``case='lower'`` folds words to lower case; ``case='keep'`` counts them as written.
    """
    if case not in ("lower", "keep"):
        raise ValueError(f"case must be 'lower' or 'keep', not {case!r}")
    w = words(lines, text, "word")
    if case == "lower":
        w = w.select(F.lower("word").alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
