"""Golden samples of the original programs' notes (G1-G8 of FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from conftest import write_files
from linebeam import sinks
from linebeam.functions.xmlrow import creation_year
from linebeam.operators import index, joins, partition, stats, wordcount
from linebeam.sources import records, text


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_g1_first_char_count(spark):
    lines = spark.createDataFrame([("it is what it is",), ("what is it",), ("it is a banana",)], "value string")
    out = wordcount.first_char_count(lines)
    assert rows(out, "letter", "n") == [("a", 1), ("b", 1), ("i", 8), ("w", 2)]


def test_g1_non_letters_skipped_and_unicode(spark):
    lines = spark.createDataFrame([("1st Été été _x \tÄpfel\fb",)], "value string")
    out = dict(rows(wordcount.first_char_count(lines), "letter", "n"))
    assert out == {"é": 2, "ä": 1, "b": 1}


def test_g2_average_three_files(spark, stage):
    paths = write_files(stage("avg"), {"f1": "2 4 1\n", "f2": "5 7 8\n", "f3": "9 3 6\n"})
    nums = stats.space_numbers(text.read_lines(spark, paths))
    assert stats.mean_of_line_means(nums).first()["mean"] == 5.0
    assert stats.global_mean(nums).first()["mean"] == 5.0


def test_g2b_mean_of_means_differs(spark):
    nums = stats.space_numbers(spark.createDataFrame([("1",), ("2 3 10  ",)], "value string"))
    assert stats.mean_of_line_means(nums).first()["mean"] == 3.0
    assert stats.global_mean(nums).first()["mean"] == 4.0


def test_g2_bad_line_fails_or_skips(spark):
    lines = spark.createDataFrame([("1 2",), ("3  4",), ("",)], "value string")
    with pytest.raises(Exception):
        stats.space_numbers(lines).collect()
    assert stats.space_numbers(lines, on_bad="skip").count() == 1


def test_g3_min_max_three_files(spark, stage):
    paths = write_files(stage("mm"), {"a": "2#4#1\n5#6#2\n", "b": "5#7#8\n8##9\n", "c": "9#3#6\n#5#2\n"})
    out = stats.min_max(stats.hash_numbers(text.read_lines(spark, paths))).first()
    assert (out["min"], out["max"], out["malformed"]) == (1, 9, 2)
    rep = stats.minmax_report(stats.min_max(stats.hash_numbers(text.read_lines(spark, paths)))).first()["report"]
    assert rep == "Minimum: 1\tMaximum: 9\tmalformed: 2"


def test_g3b_malformed_rules(spark):
    lines = spark.createDataFrame([("8#",), ("",), ("2147483648",), (" 5",), ("+5",)], "value string")
    bad = dict(rows(stats.hash_numbers(lines, keep=("value",)), "value", "bad"))
    assert bad == {"8#": True, "": True, "2147483648": True, " 5": True, "+5": False}
    lenient = dict(rows(stats.hash_numbers(lines, trailing_sep="ignore", keep=("value",)), "value", "bad"))
    assert lenient["8#"] is False
    assert rows(stats.malformed_lines(lines), "line") == [("",), (" 5",), ("2147483648",), ("8#",)]


def test_g3_no_valid_line_gives_nulls(spark):
    out = stats.min_max(stats.hash_numbers(spark.createDataFrame([("x",)], "value string"))).first()
    assert (out["min"], out["max"], out["malformed"]) == (None, None, 1)


def test_g4_inverted_index_from_files(spark, stage):
    folder = stage("idx")
    write_files(folder, {"0": "it is what it is\n", "1": "what is it\n", "2": "it is a banana\n"})
    lines = text.read_lines(spark, folder, with_file=True)
    out = dict(rows(index.inverted_index(lines, buckets=1), "word", "files"))
    assert out == {"a": "2", "banana": "2", "is": "0 1 2", "it": "0 1 2", "what": "0 1"}
    rep = dict(rows(index.inverted_index_report(index.inverted_index(lines, buckets=1)), "word", "files"))
    assert rep["is"] == "{ 0 1 2 }"
    tf = {(w, f): n for w, f, n in rows(index.posting_counts(lines), "word", "file", "tf")}
    assert tf[("it", "0")] == 2 and tf[("is", "0")] == 2 and tf[("banana", "2")] == 1


def test_o1_sorted_bytewise(spark):
    lines = spark.createDataFrame([("b a B é A",)], "value string").withColumn("file", F.lit("f"))
    idx = index.inverted_index(lines.select(F.col("value"), "file"), buckets=1)
    got = [r["word"] for r in index.sort_by_key(idx).collect()]
    assert got == ["a", "b", "é"]
    raw = wordcount.word_count(spark.createDataFrame([("b a B é A",)], "value string"), case="keep")
    assert [r["word"] for r in raw.orderBy("word").collect()] == ["A", "B", "a", "b", "é"]


XML = """<?xml version="1.0" encoding="utf-8"?>
<comments>
  <row Id="1" Kind="a" Text="Deer Bear River" UserId="4" />
  <row Id="2" Kind="b" Text="Car Car River" UserId="5" />
  <row Id="3" Kind="c" Text="How now Brown cow" UserId="6" />

</comments>
"""


def test_g5_xml_word_count(spark, stage):
    folder = stage("xml")
    write_files(folder, {"comments.xml": XML})
    x = records.read_xml_rows(spark, folder)
    assert x.count() == 3
    txt = x.select(F.element_at("attrs", F.lit("Text")).alias("value"))
    low = dict(rows(wordcount.word_count(txt), "word", "n"))
    assert low == {"bear": 1, "brown": 1, "car": 2, "cow": 1, "deer": 1, "how": 1, "now": 1, "river": 2}
    keep = dict(rows(wordcount.word_count(txt, case="keep"), "word", "n"))
    assert keep == {"Bear": 1, "Brown": 1, "Car": 2, "cow": 1, "Deer": 1, "How": 1, "now": 1, "River": 2}


def test_xml_attr_map_rules(spark):
    from linebeam.functions.xmlrow import attr_map, attr_value
    df = spark.createDataFrame([('<row Id="1" A="x" A="y" B="a &amp; b" C=\'z\' />',), ("<row broken",)], "v string")
    got = df.select(attr_map(F.col("v")).alias("m"), attr_value(F.col("v"), "A").alias("a")).collect()
    assert got[0]["m"] == {"Id": "1", "A": "y", "B": "a &amp; b"}
    assert got[0]["a"] == "y"
    assert got[1]["m"] == {} and got[1]["a"] is None


def test_g6_circle_ratio(spark):
    pts = spark.range(2000).select(
        F.when(F.col("id") < 1559, F.lit(0.0)).otherwise(F.lit(2.0)).alias("x"),
        F.when(F.col("id") < 1559, F.lit(0.0)).otherwise(F.lit(2.0)).alias("y"))
    assert stats.circle_area_ratio(pts, 2.0).first()["ratio"] == 3.118
    assert dict(rows(stats.circle_label_count(pts, 2.0), "label", "n")) == {"Inside": 1559, "Outside": 441}
    edge = spark.createDataFrame([(2.0, 0.0), (float("nan"), 0.0), (None, 0.0)], "x double, y double")
    assert dict(rows(stats.circle_label_count(edge, 2.0), "label", "n")) == {"Outside": 3}


def test_points_header_file(spark, stage):
    folder = stage("pts")
    write_files(folder, {"header": "2,3\n", "p/part": "0,0\n1.5, 1.5\n0.5,0.5\n"})
    pts, r, n = records.read_points(spark, f"{folder}/p", f"{folder}/header")
    assert (r, n) == (2.0, 3.0)
    assert dict(rows(stats.circle_label_count(pts, r), "label", "n")) == {"Inside": 2, "Outside": 1}


def _g7(spark):
    users = spark.createDataFrame([("1", "u1a"), ("1", "u1b"), ("2", "u2"), (None, "u0")], "id string, raw string")
    comments = spark.createDataFrame([("1", "c1"), ("3", "c3"), (None, "c0"), ("", "ce")], "uid string, raw string")
    return users, comments


@pytest.mark.parametrize("how,expected", [
    ("inner", [("u1a", "c1"), ("u1b", "c1")]),
    ("LeftOuter", [("u1a", "c1"), ("u1b", "c1"), ("u2", "")]),
    ("rightouter", [("", "c3"), ("", "ce"), ("u1a", "c1"), ("u1b", "c1")]),
    ("fullouter", [("", "c3"), ("", "ce"), ("u1a", "c1"), ("u1b", "c1"), ("u2", "")]),
    ("ANTI", [("", "c3"), ("", "ce"), ("u2", "")]),
])
def test_g7_joins(spark, how, expected):
    users, comments = _g7(spark)
    out = joins.record_join(users, comments, "id", "uid", how)
    assert rows(out, "user_raw", "comment_raw") == expected


def test_g7_unknown_join_type(spark):
    users, comments = _g7(spark)
    with pytest.raises(ValueError):
        joins.record_join(users, comments, "id", "uid", "semi")


def test_g8_creation_dates(spark):
    df = spark.createDataFrame([
        ("2010-08-17T19:38:20.410",), ("2010-08-17T19:38:20.410Z",), ("2010-08-17T19:38:20",),
        ("2010-08-17-17T19:38:20.410",), ("2010-13-17T19:38:20.410",), (None,)], "d string")
    got = [r["y"] for r in df.select(creation_year(F.col("d")).alias("y")).collect()]
    assert got == [2010, 2010, None, None, None, None]


def test_users_by_year_and_range(spark, stage):
    lines = spark.createDataFrame([
        ('<row Id="1" CreationDate="2008-01-01T00:00:00.000" />',),
        ('<row Id="2" CreationDate="2013-12-31T23:59:59.999" />',),
        ('<row Id="3" CreationDate="2014-01-01T00:00:00.000" />',),
        ('<row Id="4" />',), ("<users>",)], "value string")
    by = partition.users_by_year(lines)
    assert [r["year"] for r in by.orderBy("year").collect()] == [2008, 2013, 2014]
    rng = partition.year_range(by, 2008, 6)
    assert rows(rng, "year", "part") == [(2008, 0), (2013, 5)]
    path = stage("years")
    sinks.write_by_year(by, path, files_per_year=2)
    back = spark.read.text(path)
    assert rows(back, "year", "value") == rows(by.withColumnRenamed("raw", "value"), "year", "value")
    with pytest.raises(Exception):
        sinks.write_by_year(by, path)  # errorifexists by default


def test_by_year_and_cluster(spark):
    lines = spark.createDataFrame([
        ('<row Id="1" CreationDate="2008-01-01T00:00:00.000" />',),
        ('<row Id="2" CreationDate="2009-01-01T00:00:00.000" />',),
        ('<row Id="3" CreationDate="2009-06-01T00:00:00.000" />',)], "value string")
    assert partition.by_year(lines).count() == 3
    assert rows(partition.by_year(lines, min_year=2009, num_years=1), "year", "part") == [(2009, 0), (2009, 0)]
    with pytest.raises(ValueError):
        partition.by_year(lines, min_year=2009)
    for salts in (None, 4):
        c = partition.cluster_by(partition.by_year(lines), "year", salts=salts)
        assert sorted(r["raw"] for r in c.collect()) == sorted(r["value"] for r in lines.collect())


def test_hotlist_exact_and_approximate(spark):
    from linebeam.operators import hotlist
    recs = spark.createDataFrame([(1, "alpha. x"), (2, "it's alpha"), (3, "Beta"), (4, "none here")],
                                 "id long, text string")
    hot = spark.createDataFrame([("alpha",), ("beta",)], "key string")

    def ids(**kw):
        return sorted(r["id"] for r in hotlist.hotlist_filter(recs, "text", hot, **kw).collect())
    assert ids() == [2]
    assert ids(strip=True, lower=True) == [1, 2, 3]
    assert 2 in ids(approximate=True)


def test_hotlist_judges_each_record(spark):
    """NULL and repeated ids: the text alone decides."""
    from linebeam.operators import hotlist
    recs = spark.createDataFrame([(1, "alpha"), (1, "none"), (None, "alpha")], "id long, text string")
    hot = spark.createDataFrame([("alpha",)], "key string")
    for approximate in (False, True):
        got = {(r["id"], r["text"]) for r in hotlist.hotlist_filter(recs, "text", hot, approximate=approximate, p=1e-6).collect()}
        assert got == {(1, "alpha"), (None, "alpha")}


def test_attribute_names_inside_values(spark):
    from linebeam.functions.xmlrow import attr, attr_map, attr_value
    rows_ = [('<row Title="see Text=" Text="real words" />',),
             ('<row Body="at CreationDate=" CreationDate="2011-03-05T01:02:03.004" />',),
             ('<row MyText="no" Text="" Text="last" />',), ('<row Text="" />',), ("<row />",)]
    df = spark.createDataFrame(rows_, "v string")
    got = [r[0] for r in df.select(attr_value(F.col("v"), "Text")).collect()]
    assert got == ["real words", None, "last", "", None]
    assert got == [r[0] for r in df.select(attr(attr_map(F.col("v")), "Text")).collect()]
    years = partition.users_by_year(df.withColumnRenamed("v", "value")).collect()
    assert [(r["year"], r["raw"]) for r in years] == [(2011, rows_[1][0])]


def test_file_names_with_blanks_and_signs(spark, stage):
    folder = stage("names")
    write_files(folder, {"a b": "x\n", "c=d": "x y\n", "e%41": "y\n"})
    lines = text.read_lines(spark, folder, with_file=True)
    got = {(w, f) for w, f, _ in rows(index.posting_counts(lines), "word", "file", "tf")}
    assert {f for _, f in got} == {F_ for F_ in {r["file"] for r in lines.collect()}}
    assert len({f for _, f in got}) == 3


def test_points_header_is_first_record(spark, stage):
    folder = stage("pts1")
    write_files(folder, {"part-0": "2,3\n0,0\n1.5, 1.5\n", "part-1": "0.5,0.5\n2,3\n"})
    pts, r, n = records.read_points(spark, folder)
    assert (r, n) == (2.0, 3.0)
    assert sorted((p["x"], p["y"]) for p in pts.collect()) == [(0.0, 0.0), (0.5, 0.5), (1.5, 1.5), (2.0, 3.0)]


def test_groups_are_sorted_inside_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 13).cast("int").alias("year"), F.col("id").cast("string").alias("raw"))
    for salts in (None, 4):
        out = partition.cluster_by(df, "year", salts=salts)
        parts = out.select("year", F.spark_partition_id().alias("p")).collect()
        seen = {}
        for r in parts:
            seen.setdefault(r["p"], []).append(r["year"])
        assert all(v == sorted(v) for v in seen.values())
        assert sum(map(len, seen.values())) == 1000


def test_observed_malformed_counter(spark):
    lines = spark.createDataFrame([("1#2",), ("3##4",), ("x",)], "value string")
    parsed, obs = stats.observe_malformed(stats.hash_numbers(lines))
    assert parsed.where("not bad").count() == 1
    assert obs.get["malformed"] == 2


def test_inverted_index_buckets_keep_every_file(spark):
    lines = spark.createDataFrame([(f"common w{i % 3}", f"f{i:03d}") for i in range(200)], "value string, file string")
    whole = dict(rows(index.inverted_index(lines, buckets=1), "word", "files"))
    split = index.inverted_index(lines, buckets=8)
    got = {}
    for r in split.collect():
        got.setdefault(r["word"], []).extend(r["files"].split(" "))
    assert {w: " ".join(sorted(v)) for w, v in got.items()} == whole
    assert split.where("word = 'common'").count() > 1


def test_typed_attrs_unescape_and_types(spark):
    from linebeam.functions.xmlrow import typed_attrs
    df = spark.createDataFrame([('  <row Id="1" Reputation="1600" Text="a &amp; b" />',),
                                ('<row Id="2" Reputation="x" />',), ("<row broken",)], "v string")
    got = [r["s"] for r in df.select(typed_attrs(F.col("v"), {"Id": "string", "Reputation": "int", "Text": "string"})
                                     .alias("s")).collect()]
    assert (got[0]["Id"], got[0]["Reputation"], got[0]["Text"]) == ("1", 1600, "a & b")
    assert (got[1]["Id"], got[1]["Reputation"]) == ("2", None)
    assert got[2]["Id"] is None


def test_q20_first_letter_by_code_point(spark):
    lines = spark.createDataFrame([("\U0001D49Cbc xyz 1a",)], "value string")
    assert dict(rows(wordcount.first_char_count(lines), "letter", "n")) == {"\U0001D49C": 1, "x": 1}


def test_q22_duplicate_training_keys(spark):
    from linebeam.operators import bloom as bl
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    bf = bl.bloom_build(keys, "key")
    assert bf.n == 2
    once = bl.bloom_build(keys.distinct(), "key")
    assert bf.table.first()["bits"] == once.table.first()["bits"]


def test_exact_hotlist_has_no_false_positive(spark):
    from linebeam.operators import hotlist
    def word(i):  # alphabetic, since the hot-token cleaning blanks digits
        return "w" + chr(97 + i % 26) + chr(97 + i // 26)
    recs = spark.createDataFrame([(i, f"{word(i)} x") for i in range(300)], "id long, text string")
    hot = spark.createDataFrame([(word(i),) for i in range(0, 300, 3)], "key string")
    bf = hotlist.hotlist_bloom(hot, p=0.2)
    exact = sorted(r["id"] for r in hotlist.hotlist_filter(recs, "text", hot, bf=bf).collect())
    assert exact == list(range(0, 300, 3))
    loose = {r["id"] for r in hotlist.hotlist_filter(recs, "text", hot, bf=bf, approximate=True).collect()}
    assert set(exact) <= loose
