"""Secret scan by a trigram inverted index, in DataFrame operations only.

Each rule's regular expression is turned (on the driver, over the short rule
list) into a Boolean trigram query: a text can match only if it holds all
trigrams of one alternative. The index has one posting (trigram, doc_id) per
trigram that some rule asks for; intersecting the postings of an alternative
gives its candidate documents, and the expression verifies them. A rule without
mandatory trigrams (a bare character class) scans every text.

A match's place comes from the text between matches: cutting the text at the
matches gives the lengths before each. Places are code points, the end exclusive.

Cases: null text counts as empty: no spans, the digest of the empty string. Rows
that share a doc_id (or have none) share their candidates, a superset that
verification settles row by row; every input row gives one output row. Only
``keep`` columns are returned; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linebeam.llm.common import unused

ALTERNATIVES = 64   # a rule with more literal alternatives is cut into shorter literal runs
RUN = 64            # values of a run whose totals are made apart
PIECE = 4096        # characters of a piece that redaction cuts from
SMALL_CLASS = 8     # a character class up to this size counts as alternatives


@dataclass(frozen=True)
class Rule:
    """``least`` characters in group ``group`` keep a match."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, in their listed order. {24,} and {16,} are the
# greedy runs that reach the asked length: a shorter run holds no longer one.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Further public formats
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def _runs(nodes):
    """The alternatives of a parsed expression, each a tuple of literal runs; a
    run boundary stands for text that the expression leaves open."""
    alts = [("",)]

    def follow(choices):
        nonlocal alts
        if len(alts) * len(choices) > ALTERNATIVES:
            choices = [("", "")]
        alts = list(dict.fromkeys((*a[:-1], a[-1] + c[0], *c[1:]) for a, c in product(alts, choices)))

    gap = [("", "")]
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            follow([(chr(arg).lower(),)])
        elif name == "IN":
            chars = _chars(arg)
            follow([(c,) for c in chars] if chars and len(chars) <= SMALL_CLASS else gap)
        elif name == "BRANCH":
            follow([r for branch in arg[1] for r in _runs(branch)])
        elif name == "SUBPATTERN":
            follow(_runs(arg[3]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            if low:
                follow(_runs(body))
                if high != 1:
                    follow(gap)
            else:
                follow([("",), *_runs(body)] if high == 1 else gap)
        elif name != "AT":
            follow(gap)
    return alts


def _chars(items):
    out = set()
    for op, arg in items:
        if str(op) == "LITERAL":
            out.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < SMALL_CLASS:
            out.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return sorted(out)


def trigram_query(pattern: str) -> list[frozenset] | None:
    """Alternatives of lower-case trigrams, one of which any match holds in
    full; None if some match need hold none."""
    sets = {frozenset(run[i:i + 3] for run in alt for i in range(len(run) - 2)) for alt in _runs(regex_parser.parse(pattern))}
    if frozenset() in sets:
        return None
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def candidates(docs: DataFrame, rules) -> DataFrame:
    """(doc_id, rules): the rules with trigrams that each document may match."""
    spark = docs.sparkSession
    asked = [(n, k, t, len(alt)) for n, r in enumerate(rules) for k, alt in enumerate(trigram_query(r.pattern) or ()) for t in sorted(alt)]
    queries = spark.createDataFrame(asked, "rule int, alt int, trigram string, need int")
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted({a[2] for a in asked})]))
    postings = low.select("doc_id", F.explode(held).alias("trigram"))
    return (postings.join(F.broadcast(queries), "trigram")   # as long as the rule list
           .groupBy("doc_id", "rule", "alt", "need")
            .agg(F.countDistinct("trigram").alias("held")).where("held = need")
            .groupBy("doc_id").agg(F.collect_set("rule").alias("rules")))


def _bound(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once: lambdas inside ``f`` see a variable, not its expression."""
    return F.transform(F.array(value), f)[0]


def _running(values: Column, add, zero) -> Column:
    """What ``add`` gives over the values before each place. An array can't be carried
    along and extended, which copies it each time: totals of runs of ``RUN`` values
    come first, then totals before each run, then each place's from its run's start."""
    def total(x, first, n, start):
        return F.aggregate(F.slice(x, first, n), start, lambda acc, v: add(acc, v))

    def at_places(arg):
        x, before = arg["x"], arg["before"]
        return F.transform(x, lambda _, i: total(x, F.floor(i / RUN).cast("int") * RUN + 1, (i % RUN).cast("int"), F.get(before, F.floor(i / RUN).cast("int"))))

    def with_runs(x):
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / RUN).cast("int")), lambda r: total(x, r * RUN + 1, F.lit(RUN), F.lit(zero)))
        before = _bound(runs, lambda t: F.transform(t, lambda _, r: total(t, F.lit(1), r, F.lit(zero))))
        return _bound(F.struct(x.alias("x"), before.alias("before")), at_places)

    return _bound(values, lambda x: F.when(F.size(x) > 0, with_runs(x)).otherwise(F.slice(x, 1, 0)))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, ord, kind, end) of a rule's kept matches, in text order."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    before = F.split(text, rule.pattern, -1)
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")

    def placed(m):
        gaps = F.transform(F.slice(m["b"], F.lit(1), F.size(m["m"])), lambda x: F.char_length(x))
        sizes = F.transform(m["m"], lambda x: F.char_length(x))
        return _bound(F.struct(gaps.alias("g"), sizes.alias("n"), m["k"].alias("k")), listed_spans)

    def listed_spans(m):
        at = _running(F.transform(m["g"], lambda g, i: g + F.get(m["n"], i)), lambda acc, v: acc + v, 0)
        spans = F.transform(at, lambda a, i: F.struct(
            (a + F.get(m["g"], i)).alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), (a + F.get(m["g"], i) + F.get(m["n"], i)).alias("end")))
        return F.filter(spans, lambda _, i: F.char_length(F.get(m["k"], i)) >= rule.least)

    found = F.struct(before.alias("b"), whole.alias("m"), kept.alias("k"))
    return _bound(found, lambda m: F.when(F.size(m["m"]) > 0, placed(m)).otherwise(none))


def secret_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rules=RULES, keep=(), name: str = "spans") -> DataFrame:
    """One row per document: ``doc_id``, the ``keep`` columns, and ``name``, an
    array of (start, ord, kind, end) by start, then rule order. A column of that
    name in ``keep`` is an error."""
    found = candidates(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), rules)
    same, asked = (unused(n, docs.columns) for n in ("found_id", "found_rules"))
    found = found.select(F.col("doc_id").alias(same), F.col("rules").alias(asked))
    rows = docs.select(*dict.fromkeys([doc_id, *keep, text])).join(found, F.col(doc_id).eqNullSafe(F.col(same)), "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    each = []
    for n, rule in enumerate(rules):
        spans = _spans(whole, rule, n)
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.array_contains(asked, n), spans).otherwise(none)
        each.append(spans)
    return rows.select(*dict.fromkeys([doc_id, *keep]), F.array_sort(F.concat(*each)).alias(name))


def _pieces(text: Column, size: int) -> Column:
    """The text in pieces of ``size`` characters; cut in two steps, since a cut reads all before it."""
    def cut(t, n):
        places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.char_length(t) - 1) / n).cast("int")))
        return F.transform(places, lambda i: F.substring(t, i * n + 1, F.lit(n)))
    return F.flatten(F.transform(_bound(text, lambda t: cut(t, size * RUN)), lambda t: cut(t, size)))


def _cut(pieces: Column, first: Column, last: Column, size: int) -> Column:
    """Characters first..last (exclusive) of a text in pieces, reading only the pieces that hold them."""
    a, b = F.floor(first / size).cast("int"), F.floor((last - 1) / size).cast("int")
    one = F.substring(F.get(pieces, a), first - a * size + 1, last - first)
    many = F.concat(F.substring(F.get(pieces, a), first - a * size + 1, F.lit(size)), F.array_join(F.slice(pieces, a + 2, b - a - 1), ""),
                    F.substring(F.get(pieces, b), F.lit(1), last - b * size))
    return F.when(last <= first, F.lit("")).when(a == b, one).otherwise(many)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by [kind]."""
    def join(arg):
        x, before, pieces, n = arg["x"], arg["before"], arg["pieces"], arg["n"]
        parts = F.transform(x, lambda s, i: F.when(s["start"] >= F.get(before, i), F.concat(
            _cut(pieces, F.get(before, i), s["start"], PIECE), F.lit("["), s["kind"], F.lit("]"))).otherwise(F.lit("")))
        covered = F.greatest(F.element_at(before, -1), F.element_at(x, -1)["end"])
        return F.concat(F.array_join(parts, ""), _cut(pieces, covered, n, PIECE))

    def whole(x):
        before = _running(F.transform(x, lambda s: s["end"]), lambda acc, v: F.greatest(acc, v), 0)   # where the spans so far end
        return _bound(F.struct(x.alias("x"), before.alias("before"), _pieces(text, PIECE).alias("pieces"), F.char_length(text).alias("n")), join)

    return F.when(F.size(spans) > 0, _bound(spans, whole)).otherwise(text)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``."""
    s = F.col("spans")
    count = [F.size(F.filter(s, lambda x: x["kind"] == r.kind)).cast("bigint").alias(f"n_{r.kind}") for r in BASE_RULES]
    base = F.filter(s, lambda x: x["ord"] < len(BASE_RULES))
    return secret_spans(docs).select("doc_id", *count, F.sha2(listed(base), 256).alias("base_sha256"), listed(s).alias("spans"))


def duckdb_report(table: str = "documents") -> str:
    """The report as DuckDB SQL."""
    cols = []
    for n, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        cols.append(f"regexp_extract_all(t, '{p}') AS m{n}, regexp_extract_all(t, '{p}', {r.group}) AS k{n}, string_split_regex(t, '{p}') AS b{n}")
    spans = []
    for n, r in enumerate(RULES):
        start = (f"list_sum(list_transform(b{n}[1:i], lambda x: length(x))) + "
                 f"coalesce(list_sum(list_transform(m{n}[1:i-1], lambda x: length(x))), 0)")
        spans.append(f"list_transform(list_filter(range(1, len(m{n}) + 1), lambda i: length(k{n}[i]) >= {r.least}), "
                     f"lambda i: {{'s': ({start})::BIGINT, 'o': {n}, 'k': '{r.kind}', 'e': ({start} + length(m{n}[i]))::BIGINT}})")
    every = " || ".join(spans)
    text = "list_transform({}, lambda x: x.k || ':' || x.s || ':' || x.e)"
    joined = "coalesce(list_aggregate({}, 'string_agg', ','), '')"
    base = joined.format(text.format(f"list_filter(a, lambda x: x.o < {len(BASE_RULES)})"))
    counts = ", ".join(f"len(list_filter(a, lambda x: x.o = {n}))::BIGINT AS n_{r.kind}" for n, r in enumerate(BASE_RULES))
    return (f"SELECT doc_id, {counts}, sha256({base}) AS base_sha256, {joined.format(text.format('a'))} AS spans FROM "
            f"(SELECT doc_id, list_sort({every}) AS a FROM (SELECT doc_id, {', '.join(cols)} FROM "
            f"(SELECT doc_id, coalesce(text, '') AS t FROM {table})))")
