import math
import random

import numpy as np

from linebeam.llm import topk
from linebeam.llm.topk import top_inner_products
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, score long, rank int, v long"


def brute(rows, every, k=10):
    clean = {}
    for i, x, *_ in rows:
        if i is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        q = [math.floor(1024 * float(np.float32(c))) for c in x]
        clean[i] = min(clean.get(i, q), q)
    out = []
    for i, x in clean.items():
        if i % every:
            continue
        s = sorted(((-sum(a * b for a, b in zip(x, y)), j) for j, y in clean.items() if j != i))[:k]
        out += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def run(spark, rows, every=10):
    return sorted(map(tuple, top_inner_products(frame(spark, rows), F.col("vec_id") % every == 0).collect()))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    rnd = random.Random(5)
    vec = lambda n=12: [rnd.gauss(0, 0.3) for _ in range(n)]
    same = vec()
    rows = [(i, vec() if i % 3 else same) for i in range(300)]                      # a third are one vector: ties
    rows += [(301, None), (302, [float("nan")] * 12), (303, [None] + vec(11)), (None, vec()), (310, vec(5)), (320, []),
             (304, [float("inf")] * 12), (40, vec()), (41, rows[41][1])]
    assert run(spark, rows) == brute(rows, 10)


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]) == [(0, 1, 1, 1024 * 512 + 2048 * 512), (0, 2, 2, -1024 * 1024)]
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []
    assert run(spark, []) == [] if spark else None


def test_huge_components_have_a_result(spark):
    """Components and scores beyond 64 bits count as the widest numbers; the others stay exact."""
    widest = 2 ** 63 - 1
    held = lambda x: max(-widest, min(widest, x))
    values = [1e30, -1e30, 3e38, -3e38, 1e15, -1e15, 4e12, 1.5, 0.0, -2.25]
    rnd = random.Random(8)
    rows = [(i, [rnd.choice(values) if i % 2 else rnd.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    clean = {i: [held(math.floor(1024 * float(np.float32(c)))) for c in x] for i, x in rows}
    want = []
    for i in clean:
        if i % 5 == 0:
            s = sorted((-held(sum(a * b for a, b in zip(clean[i], clean[j]))), j) for j in clean if j != i)[:10]
            want += [(i, r + 1, j, -t) for r, (t, j) in enumerate(s)]
    assert run(spark, rows, 5) == sorted(want)
    assert any(abs(w[3]) == widest for w in want)
    doubles = spark.createDataFrame([(0, [1e308]), (1, [1e308]), (2, [-1e308])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, top_inner_products(doubles, F.col("vec_id") == 0).collect()))
    assert got == [(0, 1, 1, widest), (0, 2, 2, -widest)]
