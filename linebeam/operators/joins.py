"""Keyed record joins of two record sets (inner, left, right, full, symmetric anti).

Semantics
  * rows whose key is NULL are dropped on both sides *before* the join, even
    for outer joins; an empty-string key is an ordinary key;
  * keys compare as strings (``01`` != ``1``);
  * every pair of a key is emitted (cross product within the key);
  * a missing side prints as the empty string;
  * ``anti`` is symmetric: the unmatched rows of *both* sides.

Physical design
  Outer and anti joins are assembled from an inner join plus "rows of X whose
  key does not occur in Y" pieces. The latter anti-join against the *distinct*
  keys of the other side; ``distinct`` has a map-side partial aggregate, so a
  key that holds a third of all rows collapses to one row per task before any
  shuffle. The inner join is left to AQE: a broadcast hash join when one side
  is measured small, otherwise a sort-merge join whose skewed partitions AQE
  splits (inner joins may split either side; a native full outer join may not,
  which is why it is not used). Both branches hash-partition a side on the same
  key, so Spark reuses that shuffle instead of repeating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The join type names, matched case-insensitively.
JOIN_TYPES = ("inner", "leftouter", "rightouter", "fullouter", "anti")


def join_type(name: str) -> str:
    """Normalise a join type name; ``ValueError`` on an unknown one."""
    how = str(name).lower()
    if how not in JOIN_TYPES:
        raise ValueError(f"join type must be one of {', '.join(JOIN_TYPES)} (any case), not {name!r}")
    return how


def keyed(df: DataFrame, key: str, record: str, key_name: str, rec_name: str) -> DataFrame:
    """(key string, record string) with NULL keys removed."""
    return (df.select(F.col(key).cast("string").alias(key_name), F.col(record).cast("string").alias(rec_name))
            .where(F.col(key_name).isNotNull()))


def _distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def record_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str = "inner",
                a_record: str = "raw", b_record: str = "raw",
                out_a: str = "user_raw", out_b: str = "comment_raw") -> DataFrame:
    """(out_a string, out_b string) for the join ``how`` of ``a`` and ``b``."""
    how = join_type(how)
    left = keyed(a, a_key, a_record, "_ka", "_ra")
    right = keyed(b, b_key, b_record, "_kb", "_rb")

    def matched():
        return left.join(right, left["_ka"] == right["_kb"], "inner").select(
            F.col("_ra").alias(out_a), F.col("_rb").alias(out_b))

    def only_a():
        keys_b = _distinct_keys(right, "_kb")
        return left.join(keys_b, left["_ka"] == keys_b["_kb"], "left_anti").select(
            F.col("_ra").alias(out_a), F.lit("").alias(out_b))

    def only_b():
        keys_a = _distinct_keys(left, "_ka")
        return right.join(keys_a, right["_kb"] == keys_a["_ka"], "left_anti").select(
            F.lit("").alias(out_a), F.col("_rb").alias(out_b))

    parts = {
        "inner": [matched],
        "leftouter": [matched, only_a],
        "rightouter": [matched, only_b],
        "fullouter": [matched, only_a, only_b],
        "anti": [only_a, only_b],
    }[how]
    out = parts[0]()
    for part in parts[1:]:
        out = out.unionByName(part())
    return out


def unmatched(a: DataFrame, b: DataFrame, a_key: str, b_key: str, a_record: str = "raw",
              out_a: str = "user_raw", out_b: str = "comment_raw") -> DataFrame:
    """(out_a, out_b='') for the rows of ``a`` whose key occurs in no row of
    ``b`` (NULL keys dropped): a left-anti join against ``b``'s distinct keys."""
    left = keyed(a, a_key, a_record, "_ka", "_ra")
    keys_b = _distinct_keys(b.select(F.col(b_key).cast("string").alias("_kb")).where(F.col("_kb").isNotNull()), "_kb")
    return left.join(keys_b, left["_ka"] == keys_b["_kb"], "left_anti").select(
        F.col("_ra").alias(out_a), F.lit("").alias(out_b))


def tagged_union(a: DataFrame, b: DataFrame, a_key: str, b_key: str,
                 a_record: str = "raw", b_record: str = "raw",
                 a_tag: str = "A", b_tag: str = "B") -> DataFrame:
    """(key string, tag string, raw string): both record sets in one relation,
    each row tagged with its origin; NULL keys removed."""
    ka = keyed(a, a_key, a_record, "key", "raw").withColumn("tag", F.lit(a_tag))
    kb = keyed(b, b_key, b_record, "key", "raw").withColumn("tag", F.lit(b_tag))
    return ka.unionByName(kb).select("key", "tag", "raw")
