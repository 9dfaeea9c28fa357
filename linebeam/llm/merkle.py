"""Merkle manifest of a table: a leaf a row, fanout-8 trees a group, one tree over
the groups' roots, and a proof for every row, by butterfly exchange.

1. Leaves are hashed where the rows are read; no text is shuffled. The small leaf
   rows are sorted by (group, id) over all partitions, and partial counts give
   each its place in its group, so a group may hold any share of the rows.
2. Aligned runs of 8^3 leaves form a block, the partition of the tree. A block
   builds its three lowest levels by itself.
3. Round r: the blocks whose numbers differ in base-8 digit r alone swap their
   subtree roots. Each then hashes the same ancestor redundantly and keeps the
   run it received, so after the last round every block holds the group's root
   and all upper siblings; no pass goes down again. Where the last subtree is
   smaller than its neighbours, its blocks serve several partners each.
4. The groups' roots are swapped in the same way along the digits of the group's
   number: block b of a group meets block b mod B of a group of B blocks.

A block sends at most 8 messages of one digest a round (those of a short last
subtree more, the receivers never get more than 8), so a round moves about 8
digests per 512 rows.

Cases: a null field is hashed as ``-``. Null ids come first; null groups are a
group of their own, first of all. Rows equal in id are ordered by leaf, equal
leaves are interchangeable: each row gets its own place and proof. Empty and very
long texts are hashed as any other. A single row is its own root with an empty
proof. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linebeam.llm.common import ranked, staged

FANOUT = 8
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS   # leaves of a block


def field(c: str | Column) -> Column:
    """A field as it is hashed: ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    v = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*fields), 256)


def node_hash(run: Column) -> Column:
    """The parent of a run of digests."""
    return F.sha2(F.array_join(run, ""), 256)


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: node_hash(F.slice(nodes, i * FANOUT + 1, FANOUT)))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``proof`` give."""
    return F.aggregate(proof, leaf, lambda acc, p: node_hash(
        F.concat(F.slice(p["run"], 1, p["own"]), F.array(acc), F.slice(p["run"], p["own"] + 2, FANOUT))))


def proof_hash(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    siblings = F.transform(proof, lambda p: F.array_join(
        F.concat(F.slice(p["run"], 1, p["own"]), F.slice(p["run"], p["own"] + 2, FANOUT)), ""))
    return F.sha2(F.array_join(siblings, ""), 256)


def _placed(leaves: DataFrame, group: str, order: str):
    """``leaves`` with the group's number j, its size n, and the row's place pos in
    it; and the groups (j, n). What is counted has a row per (partition, group)."""
    rows = staged(leaves, "leaves")
    parts = staged(rows.orderBy(F.asc_nulls_first(group), F.asc_nulls_first(order), "leaf")
                   .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mid")), "sorted-leaves")
    spans = parts.groupBy(F.col("part").alias("p"), F.col(group).alias("g")).agg(F.count("*").alias("rows"), F.min("mid").alias("first"))
    before = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("*", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    sizes = spans.groupBy("g").agg(F.sum("rows").alias("n"))
    groups = ranked(sizes, F.asc_nulls_first("g")).select(F.col("g").alias("gg"), "n", F.col("rank").alias("j"))
    spans = spans.join(groups, F.col("g").eqNullSafe(F.col("gg"))).drop("gg", "rows")
    placed = (parts.join(spans, (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g")))
              .withColumn("pos", F.col("before") + F.col("mid") - F.col("first")))
    return placed, groups.select("j", "n")


def _blocks(placed: DataFrame, columns) -> DataFrame:
    """(j, b, n, rows, l0, l1, l2, node): a block of at most 512 rows in order, its
    levels, and its subtree's root."""
    rows = (placed.groupBy("j", F.expr(f"pos div {BLOCK}").alias("b"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("rows"))
            .withColumn("l0", F.transform("rows", lambda x: x["leaf"])))
    for level in range(BLOCK_LEVELS):   # a level exists while the group still has several nodes
        rows = rows.withColumn(f"l{level + 1}", F.when(F.col("n") > FANOUT ** level, _parents(F.col(f"l{level}"))).otherwise(F.col(f"l{level}")))
    return rows.withColumn("node", F.element_at(f"l{BLOCK_LEVELS}", 1)).drop(f"l{BLOCK_LEVELS}")


def _received(messages: DataFrame) -> DataFrame:
    """One exchange: every block's messages, in the order of their subtrees; its own state rides along."""
    return (messages.groupBy("j", "b").agg(F.sort_array(F.collect_list(F.struct("digit", "node"))).alias("run"),
                                           F.max("own").alias("own"), F.max("n").alias("n"), F.max("subroot").alias("subroot"),
                                           F.max("active").alias("active"), F.max("proof").alias("proof"))
            .withColumn("run", F.transform("run", lambda m: m["node"]))
            .select("j", "b", "n", "subroot", F.when(F.col("active"), node_hash(F.col("run"))).otherwise(F.element_at("run", 1)).alias("node"),
                    F.when(F.col("active"), F.concat("proof", F.array(F.struct("run", "own")))).otherwise(F.col("proof")).alias("proof")))


def _own(is_own, *columns):
    return [F.when(is_own, F.col(c)).alias(c) for c in columns]


def _swap_blocks(state: DataFrame, r: int) -> DataFrame:
    """Round r inside the groups: along base-8 digit r of the block's number."""
    span = FANOUT ** r
    blocks = f"((n + {BLOCK - 1}) div {BLOCK})"
    at = (state.withColumn("node_no", F.expr(f"b div {span}")).withColumn("active", F.expr(f"{blocks} > {span}"))
          .withColumn("low", F.expr(f"b % {span}")).withColumn("held", F.expr(f"least({span}, {blocks} - node_no * {span})")))
    # of a subtree with fewer blocks than its neighbours, each serves every partner of the same remainder
    lows = at.select("*", F.explode(F.expr(f"case when active then sequence(low, {span - 1}L, held) else array(low) end")).alias("to_low"))
    to = F.expr(f"case when active then ((node_no div {FANOUT}) * {FANOUT} + t) * {span} + to_low else b end")
    sent = (lows.select("*", F.explode(F.expr(f"case when active then sequence(0, {FANOUT - 1}) else array(0) end")).alias("t"))
            .withColumn("to", to).where(f"to < {blocks}"))
    is_own = F.col("to") == F.col("b")
    return _received(sent.select("j", F.col("to").alias("b"), F.expr(f"node_no % {FANOUT}").cast("int").alias("digit"), "node", "active", "n",
                                 *_own(is_own, "proof", "subroot"), F.when(is_own, F.expr(f"node_no % {FANOUT}").cast("int")).alias("own")))


def _swap_groups(state: DataFrame, groups: DataFrame, count: int, r: int) -> DataFrame:
    """Round r between the groups: along base-8 digit r of the group's number."""
    span = FANOUT ** r
    low = F.explode(F.expr(f"sequence(j % {span}, {span - 1}L, least({span}, {count} - (j div {span}) * {span}))")).alias("to_low")
    pairs = (groups.select("j", F.col("n").alias("n_from"), F.expr(f"j div {span}").alias("node_no"), low)
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(FANOUT - 1))).alias("t"))
             .withColumn("to_j", F.expr(f"((node_no div {FANOUT}) * {FANOUT} + t) * {span} + to_low")))
    pairs = pairs.join(groups.select(F.col("j").alias("to_j"), F.col("n").alias("n_to")), "to_j")   # 8 rows a group
    for side in ("from", "to"):
        pairs = pairs.withColumn(f"blocks_{side}", F.expr(f"(n_{side} + {BLOCK - 1}) div {BLOCK}"))
    sent = (state.join(pairs.drop("n_from"), "j").where("b < blocks_to")
            .select("*", F.explode(F.expr("sequence(b, blocks_to - 1, blocks_from)")).alias("to_b")))
    is_own = (F.col("to_j") == F.col("j")) & (F.col("to_b") == F.col("b"))
    digit = F.expr(f"node_no % {FANOUT}").cast("int")
    return _received(sent.select(F.col("to_j").alias("j"), F.col("to_b").alias("b"), digit.alias("digit"), "node", F.lit(True).alias("active"),
                                 F.col("n_to").alias("n"), *_own(is_own, "proof", "subroot"), F.when(is_own, digit).alias("own")))


def _rounds(nodes: int) -> int:
    """Levels above ``nodes`` nodes."""
    r = 0
    while nodes > FANOUT ** r:
        r += 1
    return r


def merkle_manifest(rows: DataFrame, leaf: Column, group: str, order: str, keep: dict[str, Column]) -> DataFrame:
    """(keep..., leaf, subroot, root, proof) of every row: ``proof`` lists, from the
    leaf to the root, the run of digests at each level and the row's place in it.
    Rows are grouped by ``group`` and ordered by ``order`` inside a group."""
    inner = {f"k{i}": c for i, c in enumerate(keep.values())}
    leaves = rows.select(F.col(group).alias("group"), F.col(order).alias("order"), leaf.alias("leaf"), *[c.alias(k) for k, c in inner.items()])
    placed, groups = _placed(leaves, "group", "order")
    blocks = staged(_blocks(placed, ["leaf", *inner]), "blocks")
    groups = staged(groups, "groups")
    count, largest = groups.agg(F.count("*"), F.max("n")).first()
    state = blocks.select("j", "b", "n", "node", F.lit(None).cast("string").alias("subroot"),
                          F.expr("cast(array() as array<struct<run:array<string>,own:int>>)").alias("proof"))
    for r in range(_rounds(-(-(largest or 0) // BLOCK))):
        state = _swap_blocks(state, r)
    state = state.withColumn("subroot", F.col("node"))
    for r in range(_rounds(count)):
        state = _swap_groups(state, groups, count, r)
    upper = staged(state.select("j", "b", "subroot", F.col("node").alias("root"), F.col("proof").alias("upper")), "upper-proofs")

    def lower(i):
        """The runs inside the row's block: as many as the group has levels, three at most; then the upper ones."""
        runs = [F.struct(F.slice(f"l{k}", F.floor(i / FANOUT ** (k + 1)).cast("int") * FANOUT + 1, FANOUT).alias("run"),
                         (F.floor(i / FANOUT ** k) % FANOUT).cast("int").alias("own")) for k in range(BLOCK_LEVELS)]
        levels = sum(F.when(F.col("n") > FANOUT ** k, 1).otherwise(0) for k in range(BLOCK_LEVELS))
        return F.concat(F.slice(F.array(*runs), 1, levels), F.col("upper"))

    proved = F.transform("rows", lambda x, i: F.struct(x.alias("x"), lower(i).alias("proof")))
    out = blocks.join(upper, ["j", "b"]).select("subroot", "root", F.explode(proved).alias("e"))
    return out.select(*[F.col(f"e.x.{k}").alias(c) for k, c in zip(inner, keep)], F.col("e.x.leaf").alias("leaf"), "subroot", "root",
                      F.col("e.proof").alias("proof"))


def _duckdb_tree(name: str, leaves: str) -> str:
    """Recursive levels over ``leaves`` (grp, pos, h, cnt), and each node's siblings."""
    return f"""
{name} AS (
  SELECT grp, 0 AS lvl, pos, h, cnt FROM {leaves}
  UNION ALL
  SELECT grp, lvl + 1, pos // {FANOUT}, sha256(string_agg(h, '' ORDER BY pos)), (cnt + {FANOUT - 1}) // {FANOUT}
  FROM {name} WHERE cnt > 1 GROUP BY grp, lvl, pos // {FANOUT}, cnt),
{name}_run AS (
  SELECT grp, lvl, pos // {FANOUT} AS run, list(h ORDER BY pos) AS hs FROM {name} WHERE cnt > 1 GROUP BY ALL)"""


def duckdb_manifest(tamper_every: int = 3) -> str:
    """The query over ``documents`` in DuckDB. crc32 goes by its table, byte by byte."""
    f = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(f(c) for c in ("doc_id", "source", "lang", "n_chars"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    siblings = "array_to_string(list_concat(r.hs[1:own], r.hs[own + 2:]), '')"
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c FROM range(256) r(i))),
d AS (
  SELECT doc_id, lang, sha256({head} || {f('text')}) AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                       lambda c, s: xor(c >> 8, t[(xor(c, s) & 255) + 1])), 4294967295) % {tamper_every} = 0
              THEN sha256({head} || {f(f"translate(text, '{upper}', '{upper.lower()}')")}) END AS changed
  FROM documents, crc_table),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS grp,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h,
         count(*) OVER (PARTITION BY lang) AS cnt FROM d),{_duckdb_tree('low', 'leaves')},
subroots AS (
  SELECT 0 AS grp, grp AS pos, h, (SELECT count(*) FROM low WHERE cnt = 1) AS cnt FROM low WHERE cnt = 1),{_duckdb_tree('top', 'subroots')},
up AS (
  SELECT l.doc_id, l.grp, l.pos AS leaf_pos, l.leaf, 0 AS step, coalesce(changed, leaf) AS acc, '' AS sibs, 0 AS lvl, false AS in_top, l.pos AS place, l.cnt
  FROM leaves l
  UNION ALL
  SELECT doc_id, u.grp, leaf_pos, leaf, step + 1,
         CASE WHEN r.hs IS NULL THEN acc ELSE sha256(array_to_string(list_concat(list_append(r.hs[1:own], acc), r.hs[own + 2:]), '')) END,
         CASE WHEN r.hs IS NULL THEN sibs ELSE sibs || {siblings} END,
         CASE WHEN r.hs IS NULL THEN 0 ELSE u.lvl + 1 END, in_top OR r.hs IS NULL,
         CASE WHEN r.hs IS NULL THEN u.grp ELSE place // {FANOUT} END,
         CASE WHEN r.hs IS NULL THEN 0 ELSE cnt END
  FROM (SELECT *, CAST(place % {FANOUT} AS BIGINT) AS own FROM up) u
  LEFT JOIN (SELECT *, false AS top FROM low_run UNION ALL SELECT *, true FROM top_run) r
    ON r.top = in_top AND r.grp = (CASE WHEN in_top THEN 0 ELSE u.grp END) AND r.lvl = u.lvl AND r.run = place // {FANOUT}
  WHERE NOT in_top OR r.hs IS NOT NULL),
ends AS (SELECT *, row_number() OVER (PARTITION BY grp, leaf_pos ORDER BY step DESC) AS last FROM up)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = t.h AS verified
FROM ends e JOIN (SELECT pos AS g, h FROM subroots) s ON s.g = e.grp, (SELECT h FROM top WHERE cnt = 1) t
WHERE last = 1"""
