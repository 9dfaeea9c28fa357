"""Hot-list record filter: keep a record (once) when any of its cleaned
tokens is in a list of hot keys.

The list is a side table, staged and measured before the plan is built. The plan
for a list that fits the session's broadcast bound is map-only: each record is
tested where it is read, ``exists`` over its tokens, against the Bloom filter's bits
(``approximate=True``) or an exact hash set of the keys. No row is shuffled, and a
record's test ends at its first hot token.

A longer list is joined. The outcome depends on the text alone, so no id is needed:
the distinct words of all texts (combined before the shuffle) are cleaned and hashed
once each -> Bloom lookup (only words that may be hot go on) -> semi-join with the
distinct hot keys -> the distinct words of the texts are semi-joined with the hot
words -> the matching texts by two 64-bit numbers each -> semi-join of the records
on the same numbers. Both plans give the same rows; records with NULL or
repeated ids are judged one by one, and a NULL text matches nothing.
``approximate=True`` leaves the exact test out: no matching record is lost, others
pass at about the filter's rate per token.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linebeam.functions.text import WORD_DELIMITERS, hot_token
from linebeam.operators.bloom import BLOCK_BITS, SEEDS, BloomFilter, bits_in_scan, bloom_build, bloom_semi_filter, might_contain
from linebeam.operators.sidetable import hash_set, stage_side


def hot_keys(hot: DataFrame, key: str = "key") -> DataFrame:
    """(key string) distinct, non-NULL."""
    return hot.select(F.col(key).cast("string").alias("key")).where(F.col("key").isNotNull()).distinct()


def hotlist_bloom(hot: DataFrame, hot_key: str = "key", p: float = 0.01, block_bits: int = BLOCK_BITS,
                  family: str = "md5") -> BloomFilter:
    """Bloom filter of the distinct hot keys."""
    return bloom_build(hot, hot_key, p=p, block_bits=block_bits, family=family)


def _in_scan(records: DataFrame, text: str, side: Column, hit, strip: bool, lower: bool) -> DataFrame:
    """``hit(side, key)`` for the tokens, where the record is read; ``side`` is a scalar subquery."""
    name = next(n for n in map("_side{}".format, count()) if n not in records.columns)

    def token_is_hot(word: Column) -> Column:
        return F.exists(F.array(hot_token(word, strip, lower)), lambda key: (F.length(key) > 0) & hit(F.col(name), key))   # cleans a token once
    return (records.withColumn(name, side).where(F.exists(F.split(F.col(text), WORD_DELIMITERS), token_is_hot))
            .select(*records.columns))


def _joined(records: DataFrame, text: str, keys: DataFrame | None, bf: BloomFilter, strip: bool, lower: bool) -> DataFrame:
    words = F.array_distinct(F.split(F.col("_raw"), WORD_DELIMITERS))
    texts = records.select(F.col(text).alias("_raw")).where(F.col("_raw").isNotNull())
    vocabulary = texts.select(F.explode(words).alias("_word")).distinct().where(F.col("_word") != "")
    cleaned = vocabulary.select("_word", hot_token(F.col("_word"), strip, lower).alias("_key")).where(F.length("_key") > 0)
    hits = bloom_semi_filter(cleaned, "_key", bf)
    if keys is not None:
        hits = hits.join(keys, hits["_key"] == keys["key"], "left_semi")
    # a text goes by two 64-bit numbers: 16 bytes a word in the shuffle, whatever its length
    found = (texts.select(*[n.alias(f"_t{i}") for i, n in enumerate(_numbers("_raw"))], F.explode(words).alias("_word"))
             .join(hits.select("_word"), "_word", "left_semi").select("_t0", "_t1").distinct())
    same = [n == found[f"_t{i}"] for i, n in enumerate(_numbers(text))]
    return records.where(F.col(text).isNotNull()).join(found, same, "left_semi")


def _numbers(text: str) -> list[Column]:
    return [F.xxhash64(F.lit(seed), F.col(text)) for seed in SEEDS]


def hotlist_filter(records: DataFrame, text: str, hot: DataFrame, hot_key: str = "key", strip: bool = False,
                   lower: bool = False, approximate: bool = False, p: float = 0.01,
                   bf: BloomFilter | None = None, family: str = "md5") -> DataFrame:
    """Records (all columns) with at least one cleaned token in ``hot``; ``bf``
    reuses a filter already built on the same keys."""
    side = stage_side(hot_keys(hot, hot_key), "hot-keys")
    if not approximate and side.fits():
        keys = hash_set(side, "key", side.rows.count())
        return _in_scan(records, text, keys.row, keys.contains, strip, lower)
    bf = bf or hotlist_bloom(side.rows, "key", p, family=family)
    if approximate and bf.fits:
        return _in_scan(records, text, bits_in_scan(bf), lambda bits, key: might_contain(bits, key, bf), strip, lower)
    return _joined(records, text, None if approximate else side.rows, bf, strip, lower)
