"""Near-duplicate components: bottom-k sketches from one hash function.

1. One pass hashes each text's five-word shingles. Texts with the same set form
   a class, named by its smallest doc_id; only classes go on, so copies cost
   one aggregated row.
2. A class keeps its ``k`` smallest hashes. Values held by one class only can
   join nothing. Two sets with Jaccard >= t share at least c(k) retained values
   (``min_overlap``), so they share one of the k - c + 1 rarest of each; only
   these enter the inverted lists, and a passage that many texts quote stays
   out of them unless it is most of a text.
3. Short lists give their pairs. A long list gives one star: its smallest class
   against the others. The estimate from the union's bottom-k sketch filters
   pairs; the full sets decide.
4. After a star most long lists lie in one component and are done. Members of
   the others go through the same lists once more with the *full* sets (an
   exact prefix filter, c = ceil(t * n)): only values that two components hold
   count, and a pair must have room for the overlap. Long lists are cut into
   chunks that meet two at a time. What comes out is a spanning forest of the
   possible pairs, so at most a row per member; its trees are clusters, inside
   which the full sets are compared, and again a spanning forest of the links
   comes out. No step turns the pairs of a group into rows.
5. Components by large-star/small-star.

Nothing is capped: list length only chooses between steps 3 and 4.

Cases: null or empty text: no shingles, own component. A row without doc_id
cannot name a component: it is returned with component_id null, kept false and
takes no part in links. Repeated rows: each is returned; equal rows agree.
An empty table gives no rows. Extra columns of the input are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linebeam.llm.common import bit_of, bit_table, in_table, staged
from linebeam.llm.graph import components
from linebeam.llm.shingles import WordHashes, shingle_set

K = 64                # retained hashes of a set
SIGMAS = 5.0          # slack of the sketch statistics, in standard deviations
SHORT_LIST = 8        # a list up to this long gives all its pairs at once
PAIR_WORDS = 1 << 18  # signature words of the pairs that are compared at a time
CHUNK_ROWS = 1024     # members of a list that meet the same number of others in one task
SIG_WORDS = 16        # least 64-bit words of a set's bit signature
SIG_BITS = 4          # bits of it per member, at least

SKETCHED = "doc_id bigint, n_shingles int, cls binary, sketch array<bigint>"
SETS = "cid bigint, n int, sig array<bigint>, hashes array<bigint>"


def min_overlap(m, t: float):
    """Column: retained values that two sets with Jaccard >= t share at least,
    for a sketch of m values (mean less SIGMAS standard deviations)."""
    return F.greatest(F.lit(1), F.floor(t * m - SIGMAS * F.sqrt(t * (1 - t) * m)).cast("int"))


def _texts(batch, cols):
    return [batch.column(c).to_pylist() for c in cols]


def _lists(arrays, kind=pa.int64()):
    ends = np.cumsum([0] + [len(x) for x in arrays])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def _sketcher(width, k):
    def run(batches):
        cache = WordHashes()
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                ids, texts = _texts(b.slice(lo, 1000), ("doc_id", "text"))
                sets = [shingle_set(t, cache, width) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    _lists([s[:k] for s in sets])], names=["doc_id", "n_shingles", "cls", "sketch"])
    return run


def _signature(hashes):
    """A bit per hash value, in a power of two of words that grows with the set, so it
    never fills up: a bit of one set that another lacks is a member the other lacks."""
    words = SIG_WORDS
    while words * 64 < SIG_BITS * len(hashes):
        words *= 2
    bits = np.zeros(words * 64, np.uint8)
    bits[hashes.view(np.uint64) % np.uint64(len(bits))] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


class _Signatures:
    """Signatures by size; a larger one folds to a smaller one's size, since places are hashes modulo the bits."""

    def __init__(self, column):
        ends = column.offsets.to_numpy().astype(np.int64)
        flat = column.values.to_numpy().view(np.uint64)
        self.words = np.diff(ends)
        self.row, self.of = np.zeros(len(self.words), np.int64), {}
        for w in np.unique(self.words):
            at = np.flatnonzero(self.words == w)
            self.row[at] = np.arange(len(at))
            self.of[w] = flat[ends[at][:, None] + np.arange(w)]

    def rows(self, at, words):
        """The signatures of sets of one size, folded to ``words``."""
        size = self.words[at[0]]
        found = self.of[size][self.row[at]]
        return found if size == words else np.bitwise_or.reduce(found.reshape(len(at), size // words, words), axis=1)

    def possible(self, a, b, n, need):
        """Which pairs (a, b) can share ``need`` members: each set's size less the bits that the other lacks."""
        ok = np.zeros(len(a), bool)
        kind = self.words[a] * (1 << 32) + self.words[b]
        for k in np.unique(kind):
            same = np.flatnonzero(kind == k)
            words = min(k >> 32, k & 0xFFFFFFFF)
            for lo in range(0, len(same), max(1, PAIR_WORDS // words)):
                i = same[lo:lo + max(1, PAIR_WORDS // words)]
                x, y = self.rows(a[i], words), self.rows(b[i], words)
                only_a = np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)
                only_b = np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
                ok[i] = (n[a[i]] - only_a >= need[i]) & (n[b[i]] - only_b >= need[i])
        return ok


def _full_sets(width, table):
    def run(batches):
        cache = WordHashes()
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                ids, bits, texts = _texts(b.slice(lo, 500), ("doc_id", "bit", "text"))
                hit = np.flatnonzero(in_table(table.value, np.array(bits, np.int64)))
                sets = [shingle_set(texts[i], cache, width) for i in hit]
                full = [(ids[i], s) for i, s in zip(hit, sets) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _ in full], pa.int64()), pa.array([len(s) for _, s in full], pa.int32()),
                    _lists([_signature(s) for _, s in full]), _lists([s for _, s in full])], names=["cid", "n", "sig", "hashes"])
    return run


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(cid, n, sig, hashes) of the documents whose id is in ``ids`` (distinct). A
    bit table of fixed size drops most other rows before any shuffle; the join
    with ``ids`` is exact."""
    table = bit_table(ids.select(F.xxhash64("cid").alias("h")), "h")
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", bit_of(F.xxhash64("doc_id")).alias("bit"), "text")
    return rows.mapInArrow(_full_sets(width, table), SETS).join(ids, "cid", "left_semi")


def prefix_lists(postings: DataFrame, need, group: str = "cid") -> DataFrame:
    """(v, cid, n, u, i): the inverted lists of each class's rarest values.

    ``postings``: (cid, n, m, v), m values per class, and ``group``: only classes
    of different groups are to be joined, so a value that one group holds alone
    is out and counts as its classes' rarest (u of them). ``need(m)``: how many
    values two joinable classes share at least. i is the value's place among the
    class's values. At most m rows of a class meet in one group."""
    df = (postings.groupBy("v").agg(F.count("*").alias("df"), F.min(group).alias("lo"), F.max(group).alias("hi"))
          .where("lo <> hi").select("v", "df"))
    shared = (postings.join(df, "v").groupBy("cid", "n", "m")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs")))
    alone = F.col("m") - F.size("vs")
    take = F.col("m") - need(F.col("m")) + 1 - alone
    return (shared.withColumn("u", alone.cast("int")).withColumn("take", take.cast("int")).where("take > 0")
            .select("cid", "n", "u", F.posexplode(F.slice("vs", F.lit(1), F.col("take"))).alias("p", "x"))
            .select(F.col("x.v").alias("v"), "cid", "n", "u", (F.col("u") + F.col("p") + 1).alias("i")))


def _ratio(t):
    """Sizes that allow Jaccard >= t."""
    return (F.col("na") >= t * F.col("nb")) & (F.col("nb") >= t * F.col("na"))


def _sides(lists, cols):
    return [lists.select("v", F.col("cid").alias(x), *[F.col(c).alias(f"{c}{x}") for c in cols]) for x in "ab"]


def _pairs(lists: DataFrame, t: float) -> DataFrame:
    """Distinct pairs (a, b) that share a list."""
    a, b = _sides(lists, ["n"])
    return a.join(b, "v").where("a < b").where(_ratio(t)).select("a", "b").distinct()


def _forest(size, a, b):
    """(a, b) of a spanning forest of the links a-b over 0..size-1: each linked row but the smallest of its tree, with that smallest."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == label[b]).all():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label != label[label]).any():
            label = label[label]
    child = np.flatnonzero(label != np.arange(size))
    return child, label[child]


def _met(rows: DataFrame, key: str, chunk_rows: int) -> DataFrame:
    """``rows`` cut into chunks of about ``chunk_rows`` per ``key``, copied so that every two chunks meet in one (key, lo, hi)."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    cut = rows.join(sizes, key).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return met.select(*rows.columns, "chunk", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"))


def _block_links(t):
    """Which members of two chunks (or one) of a list may link across components: a spanning forest of the possible pairs."""
    def run(table):
        cols = {c: table.column(c).to_numpy() for c in ("lo", "hi", "chunk", "cid", "n", "u", "i", "comp")}
        sig = _Signatures(table.column("sig").combine_chunks())
        left, right = np.flatnonzero(cols["chunk"] == cols["lo"]), np.flatnonzero(cols["chunk"] == cols["hi"])
        a = b = np.empty(0, np.int64)
        for at in range(0, len(left), 256):
            x, y = left[at:at + 256, None], right[None, :]
            n, m = cols["n"][x], cols["n"][y]
            need = t / (1 + t) * (n + m) - 1e-9
            room = (np.minimum(cols["i"][x] - cols["u"][x], cols["i"][y] - cols["u"][y]) + np.minimum(n - cols["i"][x], m - cols["i"][y]))
            ok = (cols["comp"][x] != cols["comp"][y]) & (n >= t * m) & (m >= t * n) & (room >= need)
            p, q = np.nonzero(ok)
            u, v = left[at + p], right[q]
            k = sig.possible(u, v, cols["n"], need[p, q])
            a, b = _forest(len(cols["cid"]), np.concatenate([a, u[k]]), np.concatenate([b, v[k]]))
        return pa.table({"a": cols["cid"][a], "b": cols["cid"][b]})
    return run


def _verified_links(t):
    """Links between components of two chunks (or one) of a cluster, by the full sets: a spanning forest of them."""
    num, den = t.as_integer_ratio()

    def run(table):
        cols = {c: table.column(c).to_numpy() for c in ("lo", "hi", "chunk", "cid", "n", "comp")}
        sig = _Signatures(table.column("sig").combine_chunks())
        column = table.column("hashes").combine_chunks()
        ends, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
        left, right = np.flatnonzero(cols["chunk"] == cols["lo"]), np.flatnonzero(cols["chunk"] == cols["hi"])
        _, label = np.unique(cols["comp"], return_inverse=True)              # what is known to be linked
        found = []
        for x in left:
            n, m = cols["n"][x], cols["n"][right]
            ok = (label[right] != label[x]) & (n >= t * m) & (m >= t * n)
            y, need = right[ok], t / (1 + t) * (n + m[ok]) - 1e-9
            y = y[sig.possible(np.full(len(y), x), y, cols["n"], need)]
            mine = flat[ends[x]:ends[x + 1]]
            for z in y:
                if label[z] == label[x]:
                    continue
                shared = len(np.intersect1d(mine, flat[ends[z]:ends[z + 1]], assume_unique=True))
                if num * (n + cols["n"][z] - shared) <= den * shared:
                    label[label == label[z]] = label[x]
                    found.append((x, z))
        x, z = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": cols["cid"][x], "b": cols["cid"][z]})
    return run


def _one_of_equal_lists(lists: DataFrame) -> DataFrame:
    """Lists with the same members give the same pairs, and a passage has as many such
    lists as shingles: one of each stays. Members are compared by their number and
    two sums of their hashes."""
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), "cid").cast("decimal(38,0)"))
    members = lists.groupBy("v").agg(F.count("*").alias("s"), total(1).alias("h1"), total(2).alias("h2"))
    return lists.join(members.groupBy("s", "h1", "h2").agg(F.min("v").alias("v")).select("v"), "v", "left_semi")


def candidate_links(lists: DataFrame, t: float, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(a, b) whose components hold every pair of different ``comp`` that shares a list of
    full sets and can have the overlap that Jaccard t asks for, by two bounds that
    lose nothing: the joinable values up to the shared one and the values after it;
    and each set's size less the signature bits that the other lacks. A list is cut
    into chunks of about ``chunk_rows``, and two chunks meet in one task, so no list,
    however long, is gathered whole. A task compares its pairs as arrays and gives
    one row per member at most."""
    return _met(lists, "v", chunk_rows).groupBy("v", "lo", "hi").applyInArrow(_block_links(t), "a bigint, b bigint").distinct()


def cluster_links(candidates: DataFrame, sets: DataFrame, comp: DataFrame, t: float, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(a, b): links by full sets that join the components (``comp``: cid, comp) inside each
    cluster of candidates. A cluster's chunks meet two at a time, a set travels once
    per chunk of its cluster, and a task gives a spanning forest of what it finds."""
    named = candidates.select("a", "b").union(candidates.select(F.col("b").alias("a"), F.col("a").alias("b")))
    cluster = components(candidates, "a", "b")
    members = (named.select(F.col("a").alias("cid")).distinct().join(cluster, F.col("cid") == F.col("node"), "left")
               .select("cid", F.coalesce("component", "cid").alias("cluster")))
    rows = members.join(comp, "cid").join(sets, "cid").select("cluster", "cid", "comp", "n", "sig", "hashes")
    return _met(rows, "cluster", chunk_rows).groupBy("cluster", "lo", "hi").applyInArrow(_verified_links(t), "a bigint, b bigint").distinct()


def _estimate_filter(pairs: DataFrame, classes: DataFrame, k: int, t: float) -> DataFrame:
    """Keep pairs whose union sketch (the k smallest of both) does not rule out
    Jaccard >= t. Order-keeping upper 32 bits stand for the values."""
    s = classes.select("cid", "n_shingles", F.transform("sketch", lambda x: F.shiftright(x, 32).cast("int")).alias("s"))
    p = (pairs.join(s.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b")
         .join(s.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    low = t * F.size(union) - SIGMAS * F.sqrt(t * (1 - t) * F.size(union))
    return p.where(both >= low).select("a", "b")


def verify(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """The pairs whose full sets reach Jaccard t, compared in whole numbers."""
    p = (pairs.join(sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb")), "b")
         .join(sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha")), "a")
         .where(_ratio(t)))
    inter = F.size(F.array_intersect("ha", "hb"))
    num, den = t.as_integer_ratio()
    return p.where(den * inter >= num * (F.col("na") + F.col("nb") - inter)).select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, width: int = 5,
                    threshold: float = 0.75, k: int = K, short_list: int = SHORT_LIST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; see the
    module docstring for the method and the edge cases."""
    t = threshold
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = staged(docs.mapInArrow(_sketcher(width, k), SKETCHED), "sketches")
    classes = (rows.where("n_shingles > 0 and doc_id is not null").groupBy("cls")
               .agg(F.min("doc_id").alias("cid"), F.first("n_shingles").alias("n_shingles"),
                    F.first("sketch").alias("sketch")))
    classes = staged(classes, "classes")

    postings = classes.select("cid", F.col("n_shingles").alias("n"), F.size("sketch").alias("m"),
                              F.explode("sketch").alias("v"))
    lists = staged(prefix_lists(postings, lambda m: min_overlap(m, t)), "lists")
    sizes = lists.groupBy("v").agg(F.count("*").alias("s"), F.min(F.struct("cid", "n")).alias("lead"))
    short = lists.join(sizes.where(F.col("s").between(2, short_list)).select("v"), "v")
    long_ = lists.select("v", "cid", "n").join(sizes.where(F.col("s") > short_list).select("v", "lead"), "v")
    stars = (long_.select(F.col("lead.cid").alias("a"), F.col("cid").alias("b"),
                          F.col("lead.n").alias("na"), F.col("n").alias("nb"))
             .where("a <> b").where(_ratio(t)).select("a", "b").distinct())
    found = staged(_estimate_filter(_pairs(short, t).union(stars).distinct(), classes, k, t), "pairs")

    # only documents that a pair or a long list names
    ids = found.select(F.col("a").alias("cid")).union(found.select("b")).union(long_.select("cid")).distinct()
    sets = staged(full_sets(docs, ids, width), "sets")
    links = staged(verify(found, sets, t), "links")
    comp = components(links, "a", "b")

    # members of long lists that the stars left in more than one component
    labelled = (long_.select("v", "cid").join(comp, F.col("cid") == F.col("node"), "left")
                .select("v", "cid", F.coalesce("component", "cid").alias("comp")))
    split = (labelled.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("v"))
    rest = staged(labelled.join(split, "v", "left_semi").select("cid", "comp").distinct(), "rest")
    whole = sets.join(rest, "cid").select("cid", "n", F.col("n").alias("m"), "comp", F.explode("hashes").alias("v"))
    exact = _one_of_equal_lists(staged(prefix_lists(whole, lambda m: F.ceil(F.lit(t) * m).cast("int"), "comp"), "exact-lists"))
    maybe = staged(candidate_links(exact.join(rest, "cid").join(sets.select("cid", "sig"), "cid"), t), "candidates")
    more = cluster_links(maybe, sets, rest, t)
    comp = components(links.union(more), "a", "b")

    by_class = (classes.select("cls", "cid").join(comp, F.col("cid") == F.col("node"), "left")
                .select("cls", F.coalesce("component", "cid").alias("component_id")))
    out = rows.select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "cls").join(by_class, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (out.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def duckdb_components(table: str = "documents", width: int = 5) -> str:
    """The result as DuckDB SQL, by comparing all pairs that share a shingle;
    for tables whose ids are present and unique."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
    s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {width - 1}], ' ') AS sh
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {width - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
    links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM d JOIN comp ON comp.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""
