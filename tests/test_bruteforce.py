"""Random small inputs checked against plain-Python implementations of the
documented semantics."""

import datetime as dt
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linebeam.functions.xmlrow import creation_year
from linebeam.operators import joins, stats, wordcount

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = st.sampled_from(["1", "2", "3", "", None, "01"])


def brute_join(users, comments, how):
    us = [(k, r) for k, r in users if k is not None]
    cs = [(k, r) for k, r in comments if k is not None]
    out = []
    if how in ("inner", "leftouter", "rightouter", "fullouter"):
        out += [(ur, cr) for uk, ur in us for ck, cr in cs if uk == ck]
    ckeys, ukeys = {k for k, _ in cs}, {k for k, _ in us}
    if how in ("leftouter", "fullouter", "anti"):
        out += [(ur, "") for uk, ur in us if uk not in ckeys]
    if how in ("rightouter", "fullouter", "anti"):
        out += [("", cr) for ck, cr in cs if ck not in ukeys]
    return sorted(out)


@SETTINGS
@given(st.lists(KEYS, max_size=6), st.lists(KEYS, max_size=8))
def test_joins_match_brute_force(spark, ukeys, ckeys):
    users = [(k, f"u{i}") for i, k in enumerate(ukeys)]
    comments = [(k, f"c{i}") for i, k in enumerate(ckeys)]
    a = spark.createDataFrame(users, "id string, raw string")
    b = spark.createDataFrame(comments, "uid string, raw string")
    for how in joins.JOIN_TYPES:
        got = sorted((r["user_raw"], r["comment_raw"]) for r in joins.record_join(a, b, "id", "uid", how).collect())
        assert got == brute_join(users, comments, how), how


def brute_bad(line):
    if not re.fullmatch(r"[+-]?[0-9]+(#[+-]?[0-9]+)*", line):
        return True
    return any(not -2**31 <= int(t) < 2**31 for t in line.split("#"))


LINE = st.lists(st.sampled_from(["1", "-2", "+3", "", " 4", "x", "2147483648", "-2147483648", "07"]),
                min_size=1, max_size=4).map("#".join)


@SETTINGS
@given(st.lists(LINE, min_size=1, max_size=8))
def test_malformed_rule_matches_brute_force(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [(r["value"], r["bad"]) for r in stats.hash_numbers(df, keep=("value",)).collect()]
    assert sorted(got) == sorted((x, brute_bad(x)) for x in lines)
    mm = stats.min_max(stats.hash_numbers(df)).first()
    good = [int(t) for x in lines if not brute_bad(x) for t in x.split("#")]
    assert (mm["min"], mm["max"], mm["malformed"]) == (
        min(good) if good else None, max(good) if good else None, sum(brute_bad(x) for x in lines))


WORDS = st.lists(st.sampled_from(["it", "Is", "ábc", "Émile", "9lives", "_x", "ß", "a.b", "Zz"]), max_size=8)
SEPS = st.sampled_from([" ", "  ", "\t", "\n", " \r\n ", "\f"])


@SETTINGS
@given(st.lists(st.tuples(WORDS, SEPS), min_size=1, max_size=5))
def test_first_char_count_matches_brute_force(spark, docs):
    lines = [sep.join(ws) for ws, sep in docs]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["letter"]: r["n"] for r in wordcount.first_char_count(df).collect()}
    want = Counter(t[0].lower() for x in lines for t in re.split(r"[ \t\n\r\f]+", x) if t and t[0].isalpha())
    assert got == dict(want)


DATES = st.tuples(st.integers(1990, 2030), st.integers(0, 14), st.integers(0, 33),
                  st.integers(0, 25), st.booleans(), st.sampled_from(["", "Z", "+02:00", "x"]))


@SETTINGS
@given(st.lists(DATES, min_size=1, max_size=6))
def test_creation_year_matches_brute_force(spark, dates):
    texts = [f"{y:04d}-{mo:02d}-{d:02d}T{h:02d}:00:00" + (".123" if ms else "") + tail
             for y, mo, d, h, ms, tail in dates]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    got = [r["y"] for r in df.select(creation_year(F.col("d")).alias("y")).collect()]

    def brute(t):
        m = re.match(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}", t)
        if not m:
            return None
        try:
            return dt.datetime.strptime(m.group(0), "%Y-%m-%dT%H:%M:%S.%f").year
        except ValueError:
            return None
    assert got == [brute(t) for t in texts]
