"""The butterfly manifest against a plain tree built level by level."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from linebeam.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, n long, b long, j int, pos string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc_id, source, lang, n_chars, text):
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(root, per leaf the list of (run, own))"""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            paths[i].append((nodes[a // 8 * 8:a // 8 * 8 + 8], a % 8))
        nodes, at = [H(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)], [a // 8 for a in at]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf_of(*r[:5]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    root, top = tree([low[g][0] for g in names])
    out = []
    for g, upper in zip(names, top):
        for (_, _, leaf, r), path in zip(sorted(groups[g], key=lambda x: x[:3]), low[g][1]):
            path = path + upper
            acc, text = leaf, r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low_text = text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                acc = leaf_of(*r[:4], low_text)
            for run, own in path:
                acc = H(*run[:own], acc, *run[own + 1:])
            sibs = "".join("".join(run[:own] + run[own + 1:]) for run, own in path)
            out.append((r[0], leaf, low[g][0], root, H(sibs), acc, acc == root))
    return sorted(out, key=str)


def run(spark, rows, tmp_path, monkeypatch):
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(*r, "x", 1, 2, 3, "y") for r in rows], SCHEMA).write.mode("overwrite").parquet(path)
    return sorted(map(tuple, queries.op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def rows_of(sizes, seed=1):
    rnd = random.Random(seed)
    ids = rnd.sample(range(100000), sum(sizes))
    texts = ["Abc Ä", "", None, "lower only", "X" * 20000]
    return [(ids.pop(), rnd.choice(["s", None, ""]), f"l{g:03d}" if g else None, rnd.choice([None, 3]), rnd.choice(texts)) for g, n in enumerate(sizes) for _ in range(n)]


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [65], [1, 1], [513, 3, 1], [1030, 70, 1, 1, 1, 1, 1, 1, 1, 9]])
def test_equals_plain_tree(spark, tmp_path, monkeypatch, sizes):
    rows = rows_of(sizes)
    assert run(spark, rows, tmp_path, monkeypatch) == brute(rows)


@pytest.mark.parametrize("sizes", [[585], [73], [520, 1, 66, 9], [1] * 70 + [100], [100] + [1] * 64, [17, 513]])
def test_many_rounds_of_ragged_trees(spark, tmp_path, monkeypatch, sizes):
    """Blocks of eight leaves: up to four rounds inside a group and three between groups."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = rows_of(sizes, 2)
    assert run(spark, rows, tmp_path, monkeypatch) == brute(rows)


def test_awkward_rows(spark, tmp_path, monkeypatch):
    same = (7, "s", "en", 3, "Same")
    rows = [same] * 30 + [(None, "s", "en", 1, "T"), (None, None, None, None, None), (7, "s", "en", 3, "other"), (9, "", "", 0, "")]
    assert run(spark, rows, tmp_path, monkeypatch) == brute(rows)
    assert run(spark, [], tmp_path, monkeypatch) == []


def test_proof_of_a_changed_row_fails_and_of_others_holds(spark):
    rows = spark.range(100).select("id", F.lit("g").alias("g"))
    proved = merkle.merkle_manifest(rows, merkle.leaf_hash(merkle.field("id")), "g", "id", {"id": F.col("id")})
    bad = merkle.leaf_hash(merkle.field(F.col("id") + 1))
    out = proved.select(merkle.fold(F.col("leaf"), F.col("proof")).alias("good"), merkle.fold(bad, F.col("proof")).alias("bad"), "root")
    assert out.where("good = root and bad <> root").count() == 100
