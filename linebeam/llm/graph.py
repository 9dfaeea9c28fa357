"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.common import staged


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v)."""
    sym = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (sym.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u <> v").distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return small.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``edges`` that is not itself the
    smallest one reachable, which is its component. Alternating large-star and small-star steps, each written to
    the shared folder; it stops when a step changes nothing. All grouping is by
    minimum (map-side combined), so a node with many edges costs no more than
    its edges. Null ends and self-loops are ignored; no edges: no rows."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct())
    seen = None
    while True:
        e = staged(_stars(e) if seen else e, "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == now or now[0] == 0:
            break
        seen = now
    return e.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component"))
