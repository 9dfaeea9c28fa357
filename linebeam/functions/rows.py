"""Row-level helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, fields: dict[str, Column], keep: Callable[[Column], Column]) -> DataFrame:
    """Rows ``fields`` (each computed once per input row) for which
    ``keep(row)`` is true; ``row`` is the struct of the fields.

    ``select(expensive AS x).where(x IS NOT NULL)`` lets Catalyst push the
    predicate below the projection, so ``expensive`` runs twice -- in the
    Filter and in the Project (codegen does not share it across the two). A
    one-element array turned into 0 or 1 rows by ``inline`` computes the
    fields once: nothing is pushed below a generator.
    """
    rec = F.struct(*[col.alias(name) for name, col in fields.items()])
    return df.select(F.inline(F.filter(F.array(rec), keep)))
