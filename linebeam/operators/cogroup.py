"""The record joins by one shuffle of the tagged union.

Both record sets are one relation of (key, tag, raw). It is exchanged once, by key,
and every key's records meet as two bags; the join type says what is made of them:

    inner       each of A with each of B
    leftouter   ... and the A of a key without B, rightouter the other way round
    fullouter   both
    anti        the records of the keys that have one bag only

So an outer or symmetric anti join reads and moves each side once, where joining
and then looking for what is left moves keys again.

Bags are bounded. A key that has more than ``bag_rows`` records on a side is hot:
its A are dealt over s_a parts and its B over s_b parts of at most about
``bag_rows`` records, and the exchange is by (key, part of A, part of B), an A
record going to the s_b cells of its part and a B record to the s_a cells of its. A
pair meets in exactly one cell, and the copies are fewer than the pairs by
``bag_rows`` / 2. The counts of the hot keys say whether a bag is empty for the
key as a whole, so an empty cell of a key with both sides gives nothing. Hot keys
are found by one partial count per (key, tag); the list is a side table, at most
rows / ``bag_rows`` long, broadcast only where its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linebeam.operators.joins import join_type, tagged_union
from linebeam.operators.sidetable import SideTable, stage_side

BAG_ROWS = 2048
A, B = "A", "B"


def hot_keys(union: DataFrame, bag_rows: int = BAG_ROWS) -> SideTable:
    """(hot, s_a, s_b, both): keys with more than ``bag_rows`` records on a side, into
    how many parts each side goes, and whether both sides have records."""
    n = {t: F.count_if(F.col("tag") == t) for t in (A, B)}
    counted = union.groupBy(F.col("key").alias("hot")).agg(n[A].alias("n_a"), n[B].alias("n_b"))
    parts = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / bag_rows)).cast("int")
    return stage_side(counted.where((F.col("n_a") > bag_rows) | (F.col("n_b") > bag_rows))
                      .select("hot", parts("n_a").alias("s_a"), parts("n_b").alias("s_b"), ((F.col("n_a") > 0) & (F.col("n_b") > 0)).alias("both")), "hot-keys")


def _cells(union: DataFrame, hot: SideTable) -> DataFrame:
    """The union's rows with the cell (i, j) they go to, and ``both``; hot keys only are copied."""
    rows = union.join(hot.joinable(), F.col("key") == F.col("hot"), "left")
    # a record's part goes by its place in its input task, so equal records spread too;
    # hashed, so records at regular places do as well
    mine = F.xxhash64(F.monotonically_increasing_id())
    others = lambda s: F.sequence(F.lit(0), F.col(s) - 1)
    cells = (F.when(F.col("hot").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
             .when(F.col("tag") == A, F.transform(others("s_b"), lambda j: F.struct(F.col("mine").cast("int").alias("i"), j.alias("j"))))
             .otherwise(F.transform(others("s_a"), lambda i: F.struct(i.alias("i"), F.col("mine").cast("int").alias("j")))))
    share = F.when(F.col("tag") == A, F.col("s_a")).otherwise(F.col("s_b"))
    placed = rows.withColumn("mine", F.coalesce(F.pmod(mine, share), F.lit(0)))
    return placed.select("key", "tag", "raw", F.coalesce("both", F.lit(False)).alias("both"), F.explode(cells).alias("cell"))


def bags(a: DataFrame, b: DataFrame, a_key: str, b_key: str, a_record: str = "raw", b_record: str = "raw",
         bag_rows: int = BAG_ROWS) -> DataFrame:
    """(key, both, as, bs): the records of each key, of each cell of a hot key, as arrays
    of (raw). ``both`` is true for a hot key with records on both sides."""
    union = tagged_union(a, b, a_key, b_key, a_record, b_record, A, B)
    rows = _cells(union, hot_keys(union, bag_rows))
    bag = lambda t: F.collect_list(F.when(F.col("tag") == t, F.struct("raw")))  # noqa: E731  (a NULL record is kept)
    return rows.groupBy("key", "cell").agg(F.max("both").alias("both"), bag(A).alias("as"), bag(B).alias("bs")).drop("cell")


def cogroup_join(a: DataFrame, b: DataFrame, a_key: str, b_key: str, how: str = "inner",
                 a_record: str = "raw", b_record: str = "raw", out_a: str = "user_raw",
                 out_b: str = "comment_raw", bag_rows: int = BAG_ROWS) -> DataFrame:
    """(out_a string, out_b string): what ``record_join`` gives, by one exchange of both sides."""
    how = join_type(how)
    groups = bags(a, b, a_key, b_key, a_record, b_record, bag_rows)
    no_a, no_b = F.size("as") == 0, F.size("bs") == 0
    paired = ~no_a & ~no_b
    alone_a, alone_b = no_b & ~F.col("both"), no_a & ~F.col("both")
    keep = {"inner": paired, "leftouter": paired | alone_a, "rightouter": paired | alone_b,
            "fullouter": paired | alone_a | alone_b, "anti": alone_a | alone_b}[how]
    blank = F.array(F.struct(F.lit("").alias("raw")))

    def side(name: str, empty: Column) -> Column:
        return F.explode(F.when(empty, blank).otherwise(F.col(name)))
    return (groups.where(keep).select("bs", side("as", no_a).alias("x")).select("x", side("bs", no_b).alias("y"))
            .select(F.col("x.raw").alias(out_a), F.col("y.raw").alias(out_b)))
