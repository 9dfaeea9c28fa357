"""Fill-in-the-middle outputs against a plain version, and the exact way back."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linebeam.llm import fim
from linebeam.llm.fim import fill_in_middle, restored

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_version(doc_id, text):
    t = text or ""
    units = UNIT.findall(t)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, t, t
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}", t
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}", t


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "z", 2, "raw") for r in rows], "doc_id long, text string, kind int, output string, h1 long, form string")
    out = restored(fill_in_middle(df, **kw))
    return sorted(map(tuple, out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored").collect()), key=str)


def texts(count, seed=3):
    rnd = random.Random(seed)
    parts = ["word", "A", " ", "\n", "é", "漢字", "😀", "<", ">", "<P", "S>", "<M>", "<X>", "9", "\u0000", "́"]
    return ["".join(rnd.choice(parts if rnd.random() < 0.4 else parts[:11]) for _ in range(rnd.randrange(30))) for _ in range(count)]


@pytest.mark.parametrize("block", [1, 50, 1_000_000])
def test_equals_plain_version(spark, block):
    rows = list(enumerate(texts(400))) + [(None, "abc def"), (None, None), (5, ""), (5, ""), (1000, "x" * 60000 + " y" * 30000), (1001, "é"), (1002, "a")]
    want = sorted((plain_version(*r) for r in rows), key=str)
    assert run(spark, rows, block_bytes=block) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_empty_table_and_kept_columns(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "psm", "<P>a<S>c<M>b", 5, b"q")], "id long, form string, output string, kind int, raw binary")
    out = restored(df)
    assert out.columns == ["id", "form", "output", "kind", "raw", "restored"] and out.first()["restored"] == "abc"


def test_scatter_and_gather_are_inverse():
    rnd = np.random.default_rng(4)
    lengths = rnd.integers(0, 12, 200)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    buf = rnd.integers(97, 123, starts[-1]).astype(np.uint8)
    cuts = np.sort(np.stack([starts[:-1] + rnd.integers(0, lengths + 1) for _ in range(2)]), 0)
    form = rnd.integers(0, 3, 200)
    out, sizes = fim.scatter(buf, starts, *cuts, form)
    back, n = fim.gather(out, np.concatenate([[0], np.cumsum(sizes)]), form)
    assert (back == buf).all() and (n == lengths).all()


def test_stays_in_arrow(spark):
    plan = fill_in_middle(spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowPython" not in plan.replace("MapInArrow", "")
