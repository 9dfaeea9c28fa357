"""Records grouped by the year of their creation date.

There is no aggregation: every record is kept (duplicates too); the year is
a column, and the sink lays the records out one folder per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.functions.rows import keep_where
from linebeam.functions.xmlrow import attr_value, creation_year, is_row_line


def users_by_year(rows: DataFrame, text: str = "value", date_attr: str = "CreationDate") -> DataFrame:
    """(year int, raw string) for each row line whose date attribute parses;
    rows without the attribute or with an unparsable date are dropped."""
    lines = rows.where(is_row_line(F.col(text)))
    year = creation_year(attr_value(F.col(text), date_attr))
    return keep_where(lines, {"year": year, "raw": F.col(text)}, lambda r: r["year"].isNotNull())


def year_range(by_year: DataFrame, min_year: int, num_years: int) -> DataFrame:
    """(year, part, raw): only years ``min_year .. min_year+num_years-1``;
    ``part`` = year - min_year is the output partition number."""
    return (by_year.where(F.col("year").between(min_year, min_year + num_years - 1))
            .select("year", (F.col("year") - F.lit(min_year)).alias("part"), "raw"))


def by_year(rows: DataFrame, text: str = "value", min_year: int | None = None,
            num_years: int | None = None, date_attr: str = "CreationDate") -> DataFrame:
    """``users_by_year``, limited to ``min_year .. min_year+num_years-1`` (with
    the partition number ``part``) when both are given."""
    out = users_by_year(rows, text, date_attr)
    if min_year is None and num_years is None:
        return out
    if min_year is None or num_years is None or num_years < 1:
        raise ValueError("min_year and num_years go together (num_years >= 1)")
    return year_range(out, min_year, num_years)


def cluster_by(df: DataFrame, key: str, salts: int | None = None) -> DataFrame:
    """Rows of equal ``key`` brought to the same partition and sorted by key
    inside it (grouping without reduction). ``salts`` spreads each key over
    that many partitions, so a key holding a third of all rows is not one task."""
    if salts:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
        return df.repartition(F.col(key), salt).sortWithinPartitions(key)
    return df.repartition(key).sortWithinPartitions(key)
