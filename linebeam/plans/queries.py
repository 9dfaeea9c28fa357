"""Named queries: each binds the test tables (``plans.tables``) to one
operator and returns a DataFrame. Source and sink queries write the bound
data below the session's shared checkpoint folder and read it back, so the
written files are what is compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam import sinks
from linebeam.functions.rows import keep_where
from linebeam.functions.xmlrow import attr, attr_map, attr_value, typed_attrs
from linebeam.operators import bloom as bl
from linebeam.operators import bloomjoin, cogroup, hotlist, index, joins, partition, stats, wordcount
from linebeam.plans import tables as T
from linebeam.session import scratch_dir
from linebeam.sources import records as src_records
from linebeam.sources import text as src_text

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- text

def q_first_char_count(spark, d):
    return wordcount.first_char_count(T.word_lines(spark, d))


def q_xml_word_count(spark, d):
    rows = T.comment_rows(spark, d)
    # rows without Text give no tokens; no separate NULL filter, which Catalyst
    # would push below the projection and so evaluate the extraction twice
    text = rows.select(attr_value(F.col("value"), "Text").alias("value"))
    return wordcount.word_count(text, case="lower")


def q_inverted_index(spark, d):
    return index.inverted_index(T.word_lines(spark, d))


def q_inverted_index_report(spark, d):
    return index.inverted_index_report(index.inverted_index(T.word_lines(spark, d)))


def q_inverted_index_sorted(spark, d):
    return index.sort_by_key(index.inverted_index(T.word_lines(spark, d)), "word", "bucket")


def q_posting_counts(spark, d):
    return index.posting_counts(T.word_lines(spark, d))


def q_posting_maps(spark, d):
    return index.posting_maps_report(index.posting_maps(T.word_lines(spark, d)))


def q_hotlist_filter(spark, d):
    docs = T.table(spark, d, "documents", "doc_id", "text")
    return hotlist.hotlist_filter(docs, "text", T.hot_list(spark, d), p=T.BLOOM_P)


def q_hotlist_filter_bloom(spark, d):
    docs = T.table(spark, d, "documents", "doc_id", "text")
    return hotlist.hotlist_filter(docs, "text", T.hot_list(spark, d), approximate=True, p=T.BLOOM_P, family=T.CHECKED_FAMILY)


# ---------------------------------------------------------------- joins

def _join(how):
    def q(spark, d):
        return joins.record_join(T.users(spark, d), T.comments(spark, d), "id", "user_id", how)
    q.__name__ = f"q_join_{how}"
    return q


def _cogroup_join(how):
    def q(spark, d):
        return cogroup.cogroup_join(T.users(spark, d), T.comments(spark, d), "id", "user_id", how)
    q.__name__ = f"q_join_{how}"
    return q


def _bloom_join(how, exact=True):
    def q(spark, d):
        a = T.reputable(T.users(spark, d))
        family = {} if exact else {"family": T.CHECKED_FAMILY}   # exact rows don't depend on the hash
        return bloomjoin.bloom_join(a, T.comments(spark, d), "id", "user_id", how, p=T.BLOOM_P, exact=exact, **family)
    q.__name__ = f"q_bloom_join_{how}" + ("" if exact else "_raw")
    return q


def _member_filter(spark, d):
    a = T.reputable(T.users(spark, d))
    return bloomjoin.train_on(a, "id", p=T.BLOOM_P, family=T.CHECKED_FAMILY)


def q_bloom_semi_filter(spark, d):
    bf = _member_filter(spark, d)
    return bl.bloom_semi_filter(T.comments(spark, d), "user_id", bf)


def _filter_bits(bf: bl.BloomFilter) -> DataFrame:
    """Every set bit, with the filter's numbers."""
    return bl.bit_positions(bf).select(F.lit(bf.n).cast("bigint").alias("n"), F.lit(bf.m).cast("bigint").alias("m"),
                                       F.lit(bf.k).alias("k"), F.lit(bf.p).alias("p"), "block", "q")


def q_bloom_build(spark, d):
    return _filter_bits(_member_filter(spark, d))


def q_bloom_save_load(spark, d):
    path = scratch_dir(spark, "bloom")
    bl.bloom_save(_member_filter(spark, d), path)
    return _filter_bits(bl.bloom_load(spark, path))


def q_reputable_users(spark, d):
    return T.reputable(T.users(spark, d)).select("id")


# ---------------------------------------------------------------- statistics

def q_circle_label_count(spark, d):
    return stats.circle_label_count(T.points(spark, d), T.POINT_RADIUS)


def q_circle_area_ratio(spark, d):
    return stats.circle_area_ratio(T.points(spark, d), T.POINT_RADIUS).select(F.round("ratio", 6).alias("ratio"))


def q_line_mean(spark, d):
    lines = T.space_lines(spark, d)
    nums = stats.space_numbers(lines, keep=("orderkey",))
    return nums.select("orderkey", F.round(stats.line_mean_col(), 6).alias("mean"))


def q_mean_of_line_means(spark, d):
    return stats.mean_of_line_means(stats.space_numbers(T.space_lines(spark, d))).select(F.round("mean", 6).alias("mean"))


def q_global_mean(spark, d):
    return stats.global_mean(stats.space_numbers(T.space_lines(spark, d))).select(F.round("mean", 6).alias("mean"))


def q_min_max(spark, d):
    return stats.min_max(stats.hash_numbers(T.hash_lines(spark, d)))


def q_min_max_counter(spark, d):
    """One execution gives the numbers as its result and the malformed lines as its counter."""
    result, counter = stats.min_max_counted(stats.hash_numbers(T.hash_lines(spark, d)))
    (row,), counted = counter.run(result)
    return spark.createDataFrame([(row["min"], row["max"], counted["malformed"])], "min int, max int, malformed bigint")


def q_malformed_count(spark, d):
    return stats.malformed_count(stats.hash_numbers(T.hash_lines(spark, d)))


def q_malformed_lines(spark, d):
    return stats.malformed_lines(T.hash_lines(spark, d))


def q_minmax_report(spark, d):
    return stats.minmax_report(stats.min_max(stats.hash_numbers(T.hash_lines(spark, d))))


# ---------------------------------------------------------------- attribute rows, years

def q_xml_attr_map(spark, d):
    m = T.comment_rows(spark, d).select(attr_map(F.col("value")).alias("attrs"))
    # explode_outer: a plain explode would infer a filter that evaluates the map twice
    return (m.select(attr(F.col("attrs"), "Id").alias("id"), F.explode_outer("attrs").alias("name", "value"))
            .where(F.col("name").isNotNull()))


def q_xml_attr_project(spark, d):
    rows = T.comment_rows(spark, d)   # two attributes: read from the line, without the map of all
    return keep_where(rows, {"id": attr_value(F.col("value"), "Id"), "user_id": attr_value(F.col("value"), "UserId")},
                      lambda r: r["user_id"].isNotNull())


def q_xml_attr_typed(spark, d):
    rows = T.comment_rows(spark, d)
    t = rows.select(typed_attrs(F.col("value"), {"Id": "bigint", "UserId": "bigint", "Text": "string"}).alias("t"))
    return t.select(F.col("t.Id").alias("id"), F.col("t.UserId").alias("user_id"), F.col("t.Text").alias("text"))


def q_users_by_year(spark, d):
    return partition.users_by_year(T.user_rows(spark, d))


def q_users_by_year_grouped(spark, d):
    return partition.cluster_by(partition.users_by_year(T.user_rows(spark, d)), "year", salts=T.YEAR_SALTS)


def q_users_by_year_range(spark, d):
    return partition.year_range(partition.users_by_year(T.user_rows(spark, d)), T.MIN_YEAR, T.NUM_YEARS)


# ---------------------------------------------------------------- sources (staged, read back)

def q_src_text_lines(spark, d):
    path = scratch_dir(spark, "lines")
    sinks.write_lines(T.word_lines(spark, d), "value", path)
    return src_text.read_lines(spark, path)


def q_src_multi_path(spark, d):
    root = scratch_dir(spark, "multi")
    docs = T.table(spark, d, "documents", "text", "lang").select(F.col("text").alias("value"), "lang")
    lang = F.col("lang")
    parts = {"first": lang == "en", "other": lang != "en", "none": lang.isNull()}
    for name, cond in parts.items():
        sinks.write_lines(docs.where(cond), "value", f"{root}/{name}")
    return src_text.read_lines(spark, [f"{root}/{name}" for name in parts])


def q_src_tagged_union(spark, d):
    return joins.tagged_union(T.users(spark, d), T.comments(spark, d), "id", "user_id")


def q_src_gzip_text(spark, d):
    path = scratch_dir(spark, "gz")
    sinks.write_lines(T.hot_list(spark, d), "key", path, compression="gzip")
    return src_text.read_lines(spark, path, min_partitions=spark.sparkContext.defaultParallelism)


def q_src_xml_rows(spark, d):
    path = scratch_dir(spark, "xml")
    rows = T.comment_rows(spark, d)
    frame = spark.range(1).select(F.explode(F.array(
        F.lit('<?xml version="1.0" encoding="utf-8"?>'), F.lit("<comments>"), F.lit(""), F.lit("</comments>"))).alias("value"))
    sinks.write_lines(frame.unionByName(rows), "value", path)
    x = src_records.read_xml_rows(spark, path, keep_raw=False)
    return x.select(attr(F.col("attrs"), "Id").alias("id"), attr(F.col("attrs"), "UserId").alias("user_id"),
                    attr(F.col("attrs"), "Text").alias("text"))


def q_src_file_name(spark, d):
    root = scratch_dir(spark, "files")
    sinks.write_named_files(T.word_lines(spark, d), "file", "value", root)
    return index.inverted_index(src_text.read_named_lines(spark, root))


def q_src_points(spark, d):
    root = scratch_dir(spark, "points")
    pts = T.points(spark, d)
    lines = pts.select(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string")).alias("v"))
    header = pts.agg(F.concat_ws(",", F.lit(str(T.POINT_RADIUS)), F.count(F.lit(1)).cast("string")).alias("v"))
    sinks.write_lines(header.unionByName(lines), "v", root)
    back, r, _n = src_records.read_points(spark, root)
    return back.select("x", "y", stats.inside_circle("x", "y", r).alias("inside"))


def q_src_hash_numbers(spark, d):
    path = scratch_dir(spark, "hash")
    sinks.write_lines(T.hash_lines(spark, d), "value", path)
    lines = src_text.read_lines(spark, path)
    return stats.hash_numbers(lines, keep=("value",)).select("value", "bad")


def q_src_space_numbers(spark, d):
    path = scratch_dir(spark, "space")
    sinks.write_lines(T.space_lines(spark, d), "value", path)
    nums = stats.space_numbers(src_text.read_lines(spark, path))
    return nums.select(F.round(stats.line_mean_col(), 6).alias("mean"))


# ---------------------------------------------------------------- sinks (written, read back)

def q_sink_tsv(spark, d):
    path = scratch_dir(spark, "tsv")
    sinks.write_tsv(wordcount.first_char_count(T.word_lines(spark, d)), path)
    return spark.read.text(path)


def q_sink_lines(spark, d):
    path = scratch_dir(spark, "sinklines")
    sinks.write_lines(T.comments(spark, d), "raw", path)
    return spark.read.text(path)


def q_sink_partition_by_year(spark, d):
    path = scratch_dir(spark, "years")
    sinks.write_by_year(partition.users_by_year(T.user_rows(spark, d)), path, max_records_per_file=1_000_000)
    return spark.read.text(path).select(F.col("year").cast("int").alias("year"), F.col("value").alias("raw"))


def q_sink_years_placed(spark, d):
    path = scratch_dir(spark, "placed-years")
    by_year = partition.year_range(partition.users_by_year(T.user_rows(spark, d)), T.MIN_YEAR, T.NUM_YEARS)
    sinks.write_placed(by_year, "part", "raw", path, T.ROWS_PER_FILE)
    rows = spark.read.schema("value string, part int").text(path)
    return rows.select("part", F.col("value").alias("raw"))


def q_sink_overwrite(spark, d):
    path = scratch_dir(spark, "overwrite")
    sinks.write_lines(T.comments(spark, d), "raw", path)
    sinks.write_lines(T.reputable(T.users(spark, d)), "id", path, mode="overwrite")
    return spark.read.text(path)


QUERIES: dict[str, Query] = {
    "first_char_count": q_first_char_count,
    "xml_word_count": q_xml_word_count,
    "inverted_index": q_inverted_index,
    "inverted_index_report": q_inverted_index_report,
    "inverted_index_sorted": q_inverted_index_sorted,
    "posting_counts": q_posting_counts,
    "posting_maps": q_posting_maps,
    "hotlist_filter": q_hotlist_filter,
    "hotlist_filter_bloom": q_hotlist_filter_bloom,
    "join_inner": _join("inner"),
    "join_leftouter": _join("leftouter"),
    "join_rightouter": _join("rightouter"),
    "join_fullouter": _cogroup_join("fullouter"),
    "join_anti": _cogroup_join("anti"),
    "bloom_join_inner": _bloom_join("inner"),
    "bloom_join_leftouter": _bloom_join("leftouter"),
    "bloom_join_rightouter": _bloom_join("rightouter"),
    "bloom_join_fullouter": _bloom_join("fullouter"),
    "bloom_join_anti": _bloom_join("anti"),
    "bloom_join_rightouter_raw": _bloom_join("rightouter", exact=False),
    "bloom_join_fullouter_raw": _bloom_join("fullouter", exact=False),
    "bloom_join_anti_raw": _bloom_join("anti", exact=False),
    "bloom_semi_filter": q_bloom_semi_filter,
    "bloom_build": q_bloom_build,
    "bloom_save_load": q_bloom_save_load,
    "reputable_users": q_reputable_users,
    "circle_label_count": q_circle_label_count,
    "circle_area_ratio": q_circle_area_ratio,
    "line_mean": q_line_mean,
    "mean_of_line_means": q_mean_of_line_means,
    "global_mean": q_global_mean,
    "min_max": q_min_max,
    "min_max_counter": q_min_max_counter,
    "malformed_count": q_malformed_count,
    "malformed_lines": q_malformed_lines,
    "minmax_report": q_minmax_report,
    "xml_attr_map": q_xml_attr_map,
    "xml_attr_project": q_xml_attr_project,
    "xml_attr_typed": q_xml_attr_typed,
    "users_by_year": q_users_by_year,
    "users_by_year_grouped": q_users_by_year_grouped,
    "users_by_year_range": q_users_by_year_range,
    "src_text_lines": q_src_text_lines,
    "src_multi_path": q_src_multi_path,
    "src_tagged_union": q_src_tagged_union,
    "src_gzip_text": q_src_gzip_text,
    "src_xml_rows": q_src_xml_rows,
    "src_file_name": q_src_file_name,
    "src_points": q_src_points,
    "src_hash_numbers": q_src_hash_numbers,
    "src_space_numbers": q_src_space_numbers,
    "sink_tsv": q_sink_tsv,
    "sink_lines": q_sink_lines,
    "sink_partition_by_year": q_sink_partition_by_year,
    "sink_years_placed": q_sink_years_placed,
    "sink_overwrite": q_sink_overwrite,
}
