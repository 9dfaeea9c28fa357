import itertools
import random

from linebeam.llm import neardup
from linebeam.llm.graph import components
from linebeam.llm.neardup import near_duplicates


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """{doc_id: smallest reachable id} by comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((find(a), find(b)))
            up[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_edge_cases(spark, documents):
    got = {}
    for r in near_duplicates(documents).collect():
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert got[1] == [(6, 1, True)] and got[2] == [(6, 1, False)] and got[3] == [(6, 1, False)]
    assert got[4] == [(0, 4, True)] and got[5] == [(0, 5, True)] and got[6] == [(0, 6, True)]
    assert got[7] == [(1, 7, True)] * 2 and got[8] == [(1, 7, False)]
    assert got[10][0][1:] == (9, False) and got[9][0][2]
    assert got[None] == [(6, None, False)]
    assert sum(map(len, got.values())) == documents.count()


def test_empty_table(spark, documents):
    assert near_duplicates(documents.limit(0)).collect() == []


def _corpus(seed):
    """Random texts, one large group of near copies (many edits), and texts that are mostly one shared passage."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    out, n = [], itertools.count(1)
    base = [word() for _ in range(120)]
    passage = [word() for _ in range(60)]
    for _ in range(150):
        t = list(base)
        for _ in range(rnd.randrange(0, 6)):
            t[rnd.randrange(len(t))] = word()
        out.append((next(n), " ".join(t)))
    for _ in range(80):
        out.append((next(n), " ".join([word() for _ in range(rnd.randrange(3, 40))] + passage)))
    for _ in range(60):
        t = [word() for _ in range(rnd.randrange(1, 400))]
        out.append((next(n), " ".join(t)))
        if rnd.random() < 0.5:
            u = list(t)
            u[rnd.randrange(len(u))] = word()
            out.append((next(n), " ".join(u)))
    rnd.shuffle(out)
    return out


def test_components_equal_brute_force(spark):
    for seed, short in ((1, 8), (2, 2)):
        rows = _corpus(seed)
        want = brute(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df, short_list=short).collect()}
        assert got == want


def _trees(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {x: find(x) for x in list(up)}


def test_chunked_lists_give_the_same_candidates(spark):
    """Signatures of two sizes; whatever the chunks, the candidates' trees are those of all possible pairs."""
    sig = lambda c: [1 << c % 4] + [0] * 15 + ([1 << c % 3] + [0] * 15 if c % 2 else [])
    rows = [(v, c, 100, 0, i + 1, c // 3, sig(c)) for v in (1, 2) for i, c in enumerate(range(40))]
    lists = spark.createDataFrame(rows, "v long, cid long, n int, u int, i int, comp long, sig array<long>")
    got = [_trees(map(tuple, neardup.candidate_links(lists, 0.75, chunk).collect())) for chunk in (1024, 7, 1)]
    assert got[0] and got[0] == got[1] == got[2] and len(neardup.candidate_links(lists, 0.75).collect()) < 40


def test_a_large_group_gives_no_pair_rows(spark, monkeypatch):
    """3,000 near copies, none of which is near to all: rows out of the comparisons stay below the members."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(3000):
        t = list(base)
        for _ in range(rnd.randrange(0, 4)):
            t[rnd.randrange(60)] = f"x{rnd.randrange(10 ** 6)}"
        rows.append((i, " ".join(t)))
    counted = {}

    def counting(name):
        inner = getattr(neardup, name)

        def run(*a, **kw):
            out = neardup.staged(inner(*a, **kw), name)
            counted[name] = out.count()
            return out
        return run
    for name in ("candidate_links", "cluster_links"):
        monkeypatch.setattr(neardup, name, counting(name))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect()}
    assert got == brute(rows)
    assert max(counted.values()) < 3000


def test_cluster_links_equal_brute_force(spark):
    """Every pair inside a cluster is compared, over chunks too, and known components aren't joined twice."""
    rnd = random.Random(3)
    base = rnd.sample(range(10 ** 9), 80)
    sets = {c: sorted(set(rnd.sample(base, 70) + rnd.sample(range(10 ** 9), rnd.randrange(25)))) for c in range(60)}
    comp = {c: c // 2 * 2 for c in sets}
    edges = [(c, 0) for c in range(1, 60)]
    want = [(a, b) for a, b in itertools.combinations(sets, 2) if 4 * len(set(sets[a]) & set(sets[b])) >= 3 * len(set(sets[a]) | set(sets[b]))]
    known = [(c, k) for c, k in comp.items()]
    import numpy as np
    rows = [(c, len(x), neardup._signature(np.array(x)).tolist(), x) for c, x in sets.items()]
    table = spark.createDataFrame(rows, "cid long, n int, sig array<long>, hashes array<long>")
    for chunk in (1024, 9):
        got = neardup.cluster_links(spark.createDataFrame(edges, "a long, b long"), table, spark.createDataFrame(known, "cid long, comp long"), 0.75, chunk).collect()
        assert _trees([*map(tuple, got), *known]) == _trees(want + known) and len(want) > 30
        assert all(tuple(sorted(r)) in set(want) for r in got)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(None, 3), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df, "a", "b").collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
    assert components(df.limit(0), "a", "b").collect() == []
