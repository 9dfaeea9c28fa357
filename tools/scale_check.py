"""Scaling check: run key queries with the big tables (documents, events, orders)
replicated FACTOR times by unionByName, and build Bloom filters of ever more
distinct keys, to see that time grows at most linearly.

usage: python tools/scale_check.py FACTOR [sf_dir]
"""

from __future__ import annotations

import functools
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from linebeam.operators.bloom import bloom_build  # noqa: E402
from linebeam.plans import tables as T  # noqa: E402
from linebeam.plans.queries import QUERIES  # noqa: E402
from linebeam.session import build_session  # noqa: E402

QUERY_NAMES = ["first_char_count", "inverted_index", "posting_counts", "hotlist_filter", "hotlist_filter_bloom",
               "xml_word_count", "join_fullouter", "bloom_join_leftouter", "min_max", "users_by_year"]
BIG = ("documents", "events", "orders")


def main():
    factor = int(sys.argv[1])
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    plain = T.table

    def replicated(spark, d, name, *cols):
        df = plain(spark, d, name, *cols)
        if name in BIG and factor > 1:
            df = functools.reduce(lambda a, b: a.unionByName(b), [df] * factor)
        return df

    T.table = replicated
    spark = build_session(master=os.environ.get("SCALE_MASTER", "local[8]"), shuffle_partitions=8)
    out = {}
    for q in QUERY_NAMES:
        for _ in range(2):  # the second, warm run is reported
            t0 = time.time()
            QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[q] = round(time.time() - t0, 2)
    build = {}
    for n in (100_000, 200_000, 400_000, 800_000):
        keys = spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
        t0 = time.time()
        bloom_build(keys, "key")
        build[n] = round(time.time() - t0, 2)
    print(json.dumps({"factor": factor, "seconds": out, "bloom_build_seconds_by_keys": build}))


if __name__ == "__main__":
    main()
