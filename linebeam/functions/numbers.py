"""Parsing of number-list lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An int32 token as a strict integer parser accepts it
# (optional sign, digits, nothing else).
INT_TOKEN = "[+-]?[0-9]+"


def int_list_valid(line: Column, sep: str) -> Column:
    """True when ``line`` is int tokens separated by exactly one ``sep`` each
    and every token fits in int32 (blank lines and overflow are invalid)."""
    pattern = f"^{INT_TOKEN}({sep}{INT_TOKEN})*$"
    fits = F.forall(F.split(line, sep), lambda t: t.try_cast("int").isNotNull())
    return F.coalesce(line.rlike(pattern) & fits, F.lit(False))


def int_list(line: Column, sep: str) -> Column:
    """array<int> of the tokens; NULL elements where a token is not an int."""
    return F.transform(F.split(line, sep), lambda t: t.try_cast("int"))


def drop_trailing(line: Column, sep: str) -> Column:
    """Remove trailing separators, as a split that drops trailing empties does."""
    return F.regexp_replace(line, f"({sep})+$", "")


def array_sum(nums: Column) -> Column:
    """bigint sum of an int array (no int32 overflow)."""
    return F.aggregate(nums, F.lit(0).cast("bigint"), lambda s, x: s + x.cast("bigint"))
