"""The suffix tree's scores against a plain dictionary version, and its distributions."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from linebeam.llm import queries
from linebeam.llm.bytehash import Powers
from linebeam.llm.suffixtree import END, Tree, pack, suffix_tree_scores, token_hashes, unpack

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HELD = "crc32(cast(cast(doc_id as string) as binary)) % 7 = 2"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Plain:
    """The tree by dictionaries, straight from the docstring."""

    def __init__(self, rows, tree):
        self.tree = tree
        self.docs = [(i, held_out(i), [*WORD.findall(lower(t)), None]) for i, t in rows]
        train = [w for _, h, w in self.docs if not h]
        self.count = Counter(tuple(w[j - k:j + 1]) for w in train for k in range(tree.max_context + 1) for j in range(k, len(w)))
        self.N, self.V = sum(map(len, train)), len({x for w in train for x in w})
        total = defaultdict(float)
        for w in train:
            for j in range(len(w)):
                for k in range(1, min(j, tree.max_context) + 1):
                    s = tuple(w[j - k:j])
                    if self.count[s] >= tree.min_count:
                        total[s] += round(1e2 * (math.log(self.p(w[j], s, 1) / self.p(w[j], s[1:], 1)) - tree.min_divergence))
        self.states = {()}
        for s in sorted(total, key=len):
            if s[1:] in self.states and total[s] >= 0:
                self.states.add(s)

    def p(self, x, s, out=0):
        if not s:
            return (self.count[(x,)] + 1 - out) / max(self.N + self.V + 1 - out, 1)
        return (self.count[(*s, x)] - out + self.tree.prior * self.p(x, s[1:], out)) / (self.count[s] - out + self.tree.prior)

    def state(self, w, j):
        for k in range(min(j, self.tree.max_context), -1, -1):
            if tuple(w[j - k:j]) in self.states:
                return tuple(w[j - k:j])

    def scores(self):
        for i, held, w in self.docs:
            yield (i, held, len(w), sum(self.count[(x,)] > 0 for x in w), self.N, sum(math.log10(self.p(x, ())) for x in w),
                   sum(math.log10(self.p(w[j], self.state(w, j))) for j in range(len(w))))


def corpus(n, seed=7):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    follow = {w: rnd.sample(words, 3) for w in words}
    rows = []
    for i in range(n):
        w, text = rnd.choice(words), []
        for _ in range(rnd.randrange(40)):
            text.append(rnd.choice([w, w.upper()]))
            w = rnd.choice(follow[w]) if rnd.random() < 0.8 else rnd.choice(words)
        rows.append((i, rnd.choice([" ", "\n", "\t\x0b"]).join(text)))
    return rows


def run(spark, rows, tree, **kw):
    df = spark.createDataFrame([(*r, 1, True, b"x") for r in rows], "doc_id long, text string, block long, held boolean, words binary")
    return sorted(map(tuple, suffix_tree_scores(df.repartition(3), F.expr(HELD), tree, **kw).collect()), key=str)


def same(got, want):
    want = sorted(want, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose(np.array([g[5:] for g in got], float), np.array([w[5:] for w in want], float), rtol=1e-9)


@pytest.mark.parametrize("tree", [Tree(2, 4, 3.0, 0.02), Tree(3, 2, 1.5, 0.0), Tree(1, 1, 2.0, 0.0), Tree(0, 1, 1.0, 0.0)])
@pytest.mark.parametrize("sizes", [{"block_tokens": 100, "part_keys": 64}, {}])
def test_equals_dictionaries(spark, tree, sizes):
    rows = corpus(150)
    plain = Plain(rows, tree)
    assert tree.max_context == 0 or any(len(s) == tree.max_context for s in plain.states)
    same(run(spark, rows, tree, **sizes), plain.scores())


def test_awkward_rows(spark):
    rows = corpus(40) + [(None, "w1 w2 w3"), (None, None), (50, ""), (50, ""), (51, " \n"), (52, "É É x é " * 50), (53, "x" * 90000), (54, "w1 w2 " * 20000)]
    rows += [(60, "a b c d")] * 30
    tree = Tree(2, 3, 2.0, 0.01)
    same(run(spark, rows, tree, block_tokens=500, part_keys=256), Plain(rows, tree).scores())
    assert run(spark, [], tree) == []
    only_held = [(i, "a b") for i in range(200) if held_out(i)]
    same(run(spark, only_held, tree), Plain(only_held, tree).scores())


def test_distributions_sum_to_one():
    plain = Plain(corpus(150), Tree(2, 4, 3.0, 0.02))
    symbols = [x for (x,) in (s for s in plain.count if len(s) == 1)] + ["unknown"]
    for s in plain.states:
        assert math.isclose(sum(plain.p(x, s) for x in symbols), 1)


def test_tokens_and_packing():
    texts = ["A  b", "", "\n", "b", "É a", "a"]
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0] + [len(r) for r in raw])
    h, n = token_hashes(np.frombuffer(b"".join(raw), np.uint8), starts, Powers(), chunk=3)
    assert n.tolist() == [3, 1, 1, 2, 3, 2]
    assert h[0] == h[8] == h[10] and h[1] == h[5] and h[2] == h[3] == END and len(set(h.tolist())) == 4
    x = np.array([0, 5, 2 ** 63, 7], np.uint64)
    assert (unpack(pack(x)) == x).all() and not len(unpack(pack(x[:0])))


def test_held_out_texts_are_likelier_than_by_single_words(spark):
    out = queries.op12_suffix_tree(spark, "/root/testdata/sf0.01")
    held = out.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert held[2] > 100 and held[0] > held[1] * 0.97
    assert out.count() == 1000 and out.select("train_tokens").distinct().count() == 1
