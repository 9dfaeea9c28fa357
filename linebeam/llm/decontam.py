"""Benchmark decontamination by template windows.

Words become templates: numbers, units and names (capitalised inside a sentence)
are replaced by typed placeholders, so a question asked again with other
parameters keeps its template. Every ``width``-word template window of the
documents is looked up among those of the benchmark: a bit table of fixed size
drops most windows inside the scan, and a hash join settles the rest. Windows of
one passage lie on (nearly) one diagonal, document place less item place; they
count together, for each item window the match nearest the diagonal that holds
most, and their slots must agree: one item value stands for one document value
and the other way round, but for a share ``SLACK``. Where they don't, the windows
whose values are the item's own still count.

A document is contaminated by an item when such windows cover ``coverage`` of
the item's windows and at least ``LEAST_WORDS`` of its words; unless all its
windows match, so many words must be literal or have the item's own value.

An item whose usable windows (``LITERALS`` literal words at least) cover fewer
words goes by an exact path: all its words, lower-cased and with their values, and
the signs of arithmetic that stand alone between them are one window of its own
length, looked up and joined with the others. An item of fewer than ``ALONE``
words counts only where it stands alone, as a sentence, line or text.

Cases: null or empty texts have no windows; an item without a letter or digit
cannot be found. An item of the exact path is found only with its own values.
Signs joined to a word's end ("-7") are not compared. Items of equal text are one, named by the smallest item_id. Rows equal in
doc_id and text are one; a null doc_id is returned as null. Empty tables: no
rows. Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.bytehash import Powers, hashes_of
from linebeam.llm.common import bit_table, in_table, staged
from linebeam.llm.pieces import text_blocks
from linebeam.llm.shingles import WORD_MULTIPLIER, mix

WIDTH = 5        # words of a window
LITERALS = 3     # of them not placeholders, at least
COVERAGE = 0.5   # share of an item's windows that marks a document
DRIFT = 16       # windows whose diagonals fall in one of two staggered bins of this width count together
SLACK = 0.2      # share of slot pairs that may break the one-to-one mapping
LEAST_WORDS = 7  # words of an item that its matches cover, at least
ALONE = 4        # a whole item of fewer words must stand alone

# Units of measure that a template abstracts from
UNITS = frozenset("""
mm cm m km in ft yd mi g kg mg lb oz t l ml gal s sec min h hr hrs day days week weeks month months year years
hour hours minute minutes second seconds meter meters metre metres kilometer kilometers kilometre kilometres mile miles
foot feet inch inches yard yards gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres
gallon gallons dollar dollars cent cents euro euros usd eur gbp percent mph kmh kph hz khz mhz ghz kb mb gb tb
""".split())

LITERAL, NUMBER, UNIT, NAME = range(4)
_PLACE = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))   # one hash per type

# byte classes; every byte of a non-ASCII character counts as a letter
_SPACE, _LETTER, _DIGIT, _CLOSER, _END = np.zeros((5, 256), bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT[48:58] = True
_CLOSER[list(b"\"')]")] = True
_END[list(b".!?:")] = True
_SIGN = np.zeros(256, bool)                   # signs of arithmetic
_SIGN[list(b"+-*/=<>^%")] = True
_LEAD = np.ones(256, np.int64)                # bytes of a character by its first
_LEAD[0xC0:0xE0], _LEAD[0xE0:0xF0], _LEAD[0xF0:] = 2, 3, 4

def _lowered(text: str, size: int) -> bytes:
    """Lower case with the same number of bytes: a character whose lower case takes another number stays."""
    low = text.lower().encode("utf-8", "surrogatepass")
    if len(low) != size:
        same = lambda c: len(c.lower().encode("utf-8", "surrogatepass")) == len(c.encode("utf-8", "surrogatepass"))
        low = "".join(c.lower() if same(c) else c for c in text).encode("utf-8", "surrogatepass")
    return low


def _unit_hashes():
    words = sorted(UNITS)
    blob = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 2
    return np.sort(hashes_of(blob, ends + 1 - np.array([len(w) for w in words]), ends, Powers()))


class Words:
    """The words of a block of texts: white-space separated, outer marks stripped,
    with at least one letter or digit. All arrays have one entry per word."""

    units = None

    def __init__(self, texts, powers, whole=False):
        """``whole``: with what items that are compared in full need."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        blob = np.frombuffer(b"\n".join(raw), np.uint8)
        self.low = _lowered("\n".join(t or "" for t in texts), len(blob))
        low = np.frombuffer(self.low, np.uint8)
        ink = ~_SPACE[blob]
        starts = np.flatnonzero(ink & np.concatenate([[True], ~ink[:-1]])) if len(blob) else np.empty(0, np.int64)
        if not len(starts):
            self.text = self.first = self.last = self.kind = np.empty(0, np.int64)
            self.hash = self.signs = np.empty(0, np.uint64)
            self.opens = self.closes = np.empty(0, bool)
            return
        at, letter = np.arange(len(blob), dtype=np.int32), _LETTER[blob]
        first = np.minimum.reduceat(np.where(letter, at, len(blob)), starts)
        last = np.maximum.reduceat(np.where(letter, at, -1), starts)
        final = np.maximum.reduceat(np.where(ink & ~_CLOSER[blob], at, -1), starts)
        ends = (final >= 0) & _END[blob[final]]
        bounds = np.cumsum([len(r) + 1 for r in raw])
        text = np.searchsorted(bounds, starts, "right")
        inside = np.concatenate([[False], ~ends[:-1] & (text[1:] == text[:-1])])
        real = last >= 0
        self.text, self.first, self.last, inside = text[real], first[real], last[real], inside[real]
        self.hash = hashes_of(low, self.first, self.last, powers)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[blob])])
        changed = np.concatenate([[0], np.cumsum(blob != low)])
        stop = np.minimum(self.first + _LEAD[blob[self.first]], len(blob))
        if Words.units is None:
            Words.units = _unit_hashes()
        unit = Words.units[np.minimum(np.searchsorted(Words.units, self.hash), len(Words.units) - 1)] == self.hash
        number = digits[self.last + 1] > digits[self.first]
        name = (changed[stop] > changed[self.first]) & inside
        self.kind = np.select([number, unit, name], [NUMBER, UNIT, NAME], LITERAL)
        if not whole:
            return
        # words that begin or end a sentence, line or text
        border = blob == 10
        border[final[ends]] = True
        borders = np.concatenate([[0], np.cumsum(border)])
        opens = borders[self.first[1:]] > borders[self.last[:-1] + 1]
        self.opens, self.closes = (np.concatenate(x) if real.any() else real[:0] for x in (([[True], opens]), ([opens, [True]])))
        # the signs that stand alone before each word, after the word before it
        stop = np.maximum.reduceat(np.where(ink, at, -1), starts)
        sign = ~real & np.minimum.reduceat(_SIGN[blob] | ~ink, starts)
        with np.errstate(over="ignore"):
            seen = np.cumsum(np.where(sign, hashes_of(low, starts, stop, powers), np.uint64(0)), dtype=np.uint64)[real]
            self.signs = np.diff(seen, prepend=np.uint64(0)) if len(seen) else seen

    def slots(self, word, width):
        """The words of the window at ``word``: null for a literal, else its value, lower-cased."""
        return [None if self.kind[i] == LITERAL else self.low[self.first[i]:self.last[i] + 1].decode("utf-8", "replace")
                for i in range(word, word + width)]


def windows(words: Words, width: int):
    """(hashes, first words) of the usable windows of a block; none spans two texts."""
    n = len(words.hash) - width + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h = np.where(words.kind == LITERAL, words.hash, _PLACE[words.kind])
    acc = np.full(n, width, np.uint64)
    literal = np.zeros(n, np.int64)
    with np.errstate(over="ignore"):
        for i in range(width):
            acc = acc * WORD_MULTIPLIER + h[i:n + i]
            acc ^= acc >> np.uint64(29)
            literal += words.kind[i:n + i] == LITERAL
        acc = mix(acc).view(np.int64)
    at = np.flatnonzero((literal >= min(LITERALS, width)) & (words.text[:n] == words.text[width - 1:]))
    return acc[at], at


def wholes(words: Words, powers: Powers, length: int):
    """(hashes, first words) of all runs of ``length`` words of a block; none spans two texts."""
    n = len(words.hash) - length + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    up, down = powers.get(len(words.hash) + 1)
    with np.errstate(over="ignore"):
        total, signs = (np.concatenate([[np.uint64(0)], np.cumsum(h * up[:len(h)], dtype=np.uint64)]) for h in (words.hash, mix(words.signs)))
        # signs before the first word don't belong to the run
        acc = total[length:] - total[:n] + signs[length:] - signs[1:n + 1]
        acc = mix(acc * down[:n] + np.uint64(length)).view(np.int64)
    good = words.text[:n] == words.text[length - 1:]
    if length < ALONE:
        good &= words.opens[:n] & words.closes[length - 1:]
    at = np.flatnonzero(good)
    return acc[at], at


def _whole_items(words: Words, powers: Powers, at, width):
    """(hashes, first words, lengths) of the items whose usable windows, at ``at``, cover too few words."""
    covered = np.zeros(len(words.hash), bool)
    for i in range(width):
        covered[at + i] = True
    first, size = np.unique(words.text, return_index=True, return_counts=True)[1:]
    few = np.add.reduceat(covered, first, dtype=np.int64) < LEAST_WORDS if len(first) else np.empty(0, bool)
    out = [(words.hash[:0].view(np.int64), first[:0], size[:0])]
    for length in np.unique(size[few]).tolist():
        hashes, where = wholes(words, powers, length)
        mine = np.isin(where, first[few & (size == length)])
        out.append((hashes[mine], where[mine], np.full(mine.sum(), length)))
    return [np.concatenate(x) for x in zip(*out)]


def _scan(width, table, lengths=()):
    """One row per window (of the benchmark: all; of documents: those in the bit table).
    ``whole``: the words of an item that is compared in full, else 0; ``lengths``: those asked of documents."""
    def run(batches):
        powers = Powers()
        for b in batches:
            for part, texts in text_blocks(b, 1):
                keys = np.array(part.column(0).to_pylist(), np.int64)
                words = Words(texts, powers, table is None or bool(lengths))
                hashes, at = windows(words, width)
                total = np.bincount(words.text[at], minlength=len(texts))
                runs = [(hashes, at, np.zeros(len(at), np.int64))]
                if table is None:
                    runs.append(_whole_items(words, powers, at, width))
                for length in lengths:
                    hashes, at = wholes(words, powers, length)
                    runs.append((hashes, at, np.full(len(at), length)))
                if table is not None:
                    runs = [[x[hit] for x in r] for r in runs for hit in [in_table(table.value, r[0])]]
                hashes, at, whole = (np.concatenate(x) for x in zip(*runs))
                text = words.text[at]
                place = at - np.searchsorted(words.text, text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), pa.array(keys[text]), pa.array(place), pa.array(np.where(whole > 0, 1, total[text])), pa.array(whole),
                     pa.array([[] if n else words.slots(i, width) for i, n in zip(at.tolist(), whole.tolist())], pa.list_(pa.string()))],
                    names=["win", "key", "place", "total", "whole", "slots"])
    return run


_WINDOWS = "win bigint, key bigint, place bigint, total bigint, whole bigint, slots array<string>"


def counted(matches, total, coverage):
    """The windows of the item that the matches of a bin give away; 0 if too few.

    Each exact diagonal is judged, and the matches nearest the fullest one; where
    slots disagree, only the windows with the item's own values count."""
    diagonals, near, most = {}, {}, 0
    for m in matches:
        diagonals.setdefault(m["shift"], []).append(m)
    own = [m for m in matches if m["i"] == m["d"]]
    main = max(diagonals, key=lambda s: (len(diagonals[s]), sum(m["shift"] == s for m in own), -s))
    for m in sorted(matches, key=lambda m: (abs(m["shift"] - main), m["shift"])):
        near.setdefault(m["at"], m)
    for group in (own, list(near.values()), *diagonals.values()):
        pairs = {p for m in group for p in zip(m["i"], m["d"]) if p[0] is not None}
        if any(len({p[side] for p in pairs}) < (1 - SLACK) * len(pairs) for side in (0, 1)) and group is not own:
            continue
        words = {m["at"] + k: i == d for m in group for k, (i, d) in enumerate(zip(m["i"], m["d"]))}
        windows = len({m["at"] for m in group})
        if (windows >= coverage * total and len(words) >= LEAST_WORDS
                and (windows == total or sum(words.values()) >= LEAST_WORDS)):
            most = max(most, windows)
    return most


def _judge(coverage):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                most = [counted(m, n, coverage) for m, n in zip(part.column(3).to_pylist(), part.column(2).to_pylist())]
                found = pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(most, pa.int64())], names=["key", "item_id", "item_windows", "windows"])
                yield found.filter(pa.array([n > 0 for n in most], pa.bool_()))
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, item_id, windows, item_windows, coverage, key): one row per
    document and item it gives away; ``key`` is xxhash64(doc_id, text) of the document."""
    items = (benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text"))
             .groupBy("text").agg(F.min("item_id").alias("item_id")))
    mine = (items.select("item_id", "text").mapInArrow(_scan(width, None), _WINDOWS)
            .select("win", "whole", F.col("key").alias("item_id"), F.col("place").alias("at"),
                    F.col("total").alias("item_windows"), F.col("slots").alias("item_slots")))
    mine = staged(mine, "items")
    lengths = sorted(r["whole"] for r in mine.where("whole > 0").select("whole").distinct().collect())   # lengths of short items
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    key = F.xxhash64("doc_id", "text")
    theirs = rows.select(key.alias("key"), "text").mapInArrow(_scan(width, bit_table(mine, "win"), lengths), _WINDOWS)
    hits = theirs.select("win", "whole", "key", "place", "slots").join(mine, ["win", "whole"])
    exact = (hits.where("whole > 0").select("key", "item_id", "item_windows").distinct()
             .select("*", F.lit(1).cast("bigint").alias("windows")))
    hits = hits.where("whole = 0")
    shift = F.col("place") - F.col("at")
    bins = F.array(F.struct(F.lit(0).alias("g"), F.floor(shift / DRIFT).alias("b")),
                   F.struct(F.lit(1).alias("g"), F.floor((shift + DRIFT // 2) / DRIFT).alias("b")))
    # at most DRIFT matches of each of the item's windows meet in a group
    found = (hits.select("key", "item_id", "item_windows", F.explode(bins).alias("bin"),
                         F.struct("at", shift.alias("shift"), F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("match"))
             .groupBy("key", "item_id", "item_windows", "bin").agg(F.collect_set("match").alias("matches"))
             .where(F.size(F.array_distinct("matches.at")) >= coverage * F.col("item_windows"))
             .select("key", "item_id", "item_windows", "matches")
             .mapInArrow(_judge(coverage), "key bigint, item_id bigint, item_windows bigint, windows bigint")
             .groupBy("key", "item_id", "item_windows").agg(F.max("windows").alias("windows"))
             .unionByName(exact))
    named = rows.select("doc_id", key.alias("key")).distinct()
    return (found.join(named, "key")
            .select("doc_id", "item_id", "windows", "item_windows",
                    (F.col("windows") / F.col("item_windows")).alias("coverage"), "key"))
