"""Counters with a result, posting maps, named files, point headers, placed partitions."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from linebeam import sinks
from linebeam.operators import index, partition, stats
from linebeam.sources import records
from linebeam.sources import text as src_text
from tests.conftest import write_files
from tests.test_plans import main_plan, plan


# ---------------------------------------------------------------- result and counter

def test_numbers_and_counter_of_one_execution(spark):
    lines = spark.createDataFrame([("3#-7#5",), ("x",), ("",), (None,), ("8#",), ("9",)] * 40, "value string").repartition(5)
    result, counter = stats.min_max_counted(stats.hash_numbers(lines))
    rows, counted = counter.run(result)
    assert [tuple(r) for r in rows] == [(-7, 9)] and counted == {"malformed": 160}
    result, counter = stats.min_max_counted(stats.hash_numbers(lines.limit(0)))
    assert [tuple(r) for r in counter.run(result)[0]] == [(None, None)] and counter.observation.get == {"malformed": 0}


def test_counter_is_above_the_shuffle(spark):
    """The observed row comes out of the final aggregate: no task that may run again updates the counter."""
    result, _ = stats.min_max_counted(stats.hash_numbers(spark.createDataFrame([("1",)], "value string")))
    p = main_plan(result)
    assert p.index("CollectMetrics") < p.index("Exchange") and p.count("CollectMetrics (") == 1


# ---------------------------------------------------------------- posting maps

def test_posting_maps(spark):
    lines = spark.createDataFrame([("a b A", "f1"), ("a", "f2"), ("", "f3"), (None, "f1"), ("b\tb", "f 3"), ("a a", "f1")], "value string, file string")
    want = {("a", "f1"): 4, ("b", "f1"): 1, ("a", "f2"): 1, ("b", "f 3"): 2}
    got = index.posting_maps(lines)
    assert {(r["word"], f): n for r in got.collect() for f, n in r["tf"].items()} == want
    one = index.posting_maps_report(index.posting_maps(lines, buckets=1))
    assert {(r["word"], r["tf"]) for r in one.collect()} == {("a", "{f1=4, f2=1}"), ("b", "{f 3=2, f1=1}")}


def test_posting_map_rows_are_bounded(spark):
    """A word in every file: its map is split, and counts are combined before the shuffle."""
    lines = spark.range(4000).select(F.lit("the the").alias("value"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("file"))
    maps = index.posting_maps(lines).select(F.size("tf").alias("n"))
    assert maps.count() == 16 and maps.agg(F.max("n"), F.sum("n")).first()[:] == (max(r["n"] for r in maps.collect()), 4000)
    assert maps.agg(F.max("n")).first()[0] < 400
    assert "partial_count" in plan(index.posting_maps(lines))


# ---------------------------------------------------------------- named files

def test_names_are_carried_by_the_folders(spark, stage):
    names = ["plain", "with blank", "a/b", "x=y", "100%", "07", "é", "~1", None]
    df = spark.createDataFrame([(n, f"line {i}") for i, n in enumerate(names * 3)], "name string, line string").repartition(4)
    path = stage("named")
    sinks.write_named_files(df, "name", "line", path)
    assert sorted(map(tuple, src_text.read_named_lines(spark, path).select("file", "value").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert not glob.glob(f"{path}/_folders") and len(glob.glob(f"{path}/file=*")) == len(names)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.write_named_files(df, "name", "line", path)


# ---------------------------------------------------------------- points

def read(spark, folder, files):
    write_files(folder, files)
    points, r, n = records.read_points(spark, folder)
    return sorted(map(tuple, points.collect())), r, n


def test_header_is_left_out_by_its_place(spark, stage):
    """A point that looks like the header stays, in the first file and in others."""
    got = read(spark, stage("p"), {"a": "\n  \n2,3\n0.5,1\n2,3\n", "b": "2,3\n 1 , 1\n\n"})
    assert got == ([(0.5, 1.0), (1.0, 1.0), (2.0, 3.0), (2.0, 3.0)], 2.0, 3.0)


def test_header_behind_empty_files(spark, stage):
    assert read(spark, stage("p"), {"a": "", "b": "\n\n", "c 1%": "5,1\n1,2", "d": "3,4"}) == ([(1.0, 2.0), (3.0, 4.0)], 5.0, 1.0)
    with pytest.raises(ValueError):
        read(spark, stage("p"), {"a": "\n"})


def test_points_are_scanned_once(spark, stage):
    folder = stage("p")
    write_files(folder, {"a": "2,3\n0.5,1\n", "b": "1,1\n", "c": "1,2\n"})
    points, _, _ = records.read_points(spark, folder)
    p = main_plan(points)
    assert p.count("Scan csv") in (2, 4) and "Aggregate" not in p and "Exchange" not in p   # tree and details: the first file, the others
    files = points.select(F.count("*")).collect()[0][0]
    assert files == 3


def test_large_first_file_has_one_header(spark, stage):
    """Several splits of the first file: the header is in the first one only."""
    folder = stage("p")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got, r, n = read(spark, folder, {"a": "9,1000\n" + "".join(f"{i},9\n" for i in range(1000)), "b": "9,1000\n"})
        assert len(got) == 1001 and (r, n) == (9.0, 1000.0) and (9.0, 1000.0) in got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ---------------------------------------------------------------- placed partitions

def test_rows_go_to_the_tasks_of_their_number(spark, stage):
    rnd = random.Random(2)
    rows = [(rnd.choice([0, 0, 0, 1, 2, 5, None]), f"r{i}") for i in range(6000)] + [(9, "alone")]
    df = spark.createDataFrame(rows, "part int, raw string").repartition(5)
    path = stage("placed")
    files = sinks.write_placed(df, "part", "raw", path, 500)
    back = spark.read.schema("value string, part int").text(path)
    assert sorted(map(tuple, back.select("part", "value").collect()), key=str) == sorted(rows, key=str)
    counts = {p: sum(r[0] == p for r in rows) for p in {r[0] for r in rows}}
    found = {os.path.basename(d): len(glob.glob(f"{d}/part-*")) for d in glob.glob(f"{path}/part=*")}
    assert found == {f"part={'__HIVE_DEFAULT_PARTITION__' if p is None else p}": -(-n // 500) for p, n in counts.items()}
    assert sum(found.values()) == files
    biggest = max(len(open(f).readlines()) for f in glob.glob(f"{path}/part=0/part-*"))
    assert biggest < 750     # a number with a third of the rows is written by as many tasks as it needs


def test_nothing_to_place(spark, stage):
    path = stage("placed")
    assert sinks.write_placed(spark.createDataFrame([], "part int, raw string"), "part", "raw", path, 10) == 0
    assert glob.glob(f"{path}/part=*") == []


def test_year_range_is_placed_by_partition_number(spark, stage):
    lines = spark.createDataFrame([(f'<row Id="{i}" CreationDate="{2005 + i % 12}-01-01T00:00:00.000" />',) for i in range(240)], "value string")
    by_year = partition.by_year(lines, min_year=2008, num_years=6)
    path = stage("placed")
    assert sinks.write_placed(by_year, "part", "raw", path, 1000) == 6
    assert sorted(os.path.basename(d) for d in glob.glob(f"{path}/part=*")) == [f"part={i}" for i in range(6)]
    assert spark.read.text(path).count() == 120
