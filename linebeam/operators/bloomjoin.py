"""Record joins with a Bloom-filter prefilter on the big (comment) side.

The filter is trained on the keys of the already-filtered small side ``a``
(e.g. reputable users); rows of ``b`` that surely have no partner are dropped
before they are shuffled for the join. ``exact=True`` (default) gives what a
perfect filter would give: false positives never reach the output, so
``rightouter`` equals ``inner``, ``fullouter`` equals ``leftouter`` and
``anti`` is the ``a`` rows without partner. ``exact=False`` keeps the rows
that a real filter lets through (unmatched ``b`` rows that passed the filter).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from linebeam.operators.bloom import BLOCK_BITS, BloomFilter, bloom_build, bloom_semi_filter
from linebeam.operators.joins import join_type, record_join, unmatched

_EXACT_FORM = {"inner": "inner", "leftouter": "leftouter", "rightouter": "inner",
               "fullouter": "leftouter", "anti": "anti_a"}


def train_on(a: DataFrame, a_key: str, p: float = 0.01, block_bits: int = BLOCK_BITS, family: str = "xxhash64") -> BloomFilter:
    """Filter on the distinct non-NULL keys of ``a``."""
    return bloom_build(a, a_key, p=p, block_bits=block_bits, family=family)


def bloom_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str = "inner",
               a_record: str = "raw", b_record: str = "raw", bf: BloomFilter | None = None,
               p: float = 0.01, exact: bool = True, block_bits: int = BLOCK_BITS, family: str = "xxhash64",
               out_a: str = "user_raw", out_b: str = "comment_raw") -> DataFrame:
    """(out_a, out_b) of ``a`` joined with the Bloom-prefiltered ``b``."""
    how = join_type(how)
    b_pre = bloom_semi_filter(b, b_key, bf or train_on(a, a_key, p, block_bits, family))
    if not exact:
        return record_join(a, b_pre, a_key, b_key, how, a_record, b_record, out_a, out_b)
    form = _EXACT_FORM[how]
    if form == "anti_a":
        return unmatched(a, b_pre, a_key, b_key, a_record, out_a, out_b)
    return record_join(a, b_pre, a_key, b_key, form, a_record, b_record, out_a, out_b)
