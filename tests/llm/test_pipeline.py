"""Each stage against a plain rule on its own input, and the whole chain on a small table."""

import base64
import re

import pytest
import public_tokenizers as P
import tiktoken
from .test_neardup import brute
from .test_secrets import base

import corpus_pipeline
from linebeam.llm import toxicity
from linebeam.llm.decontam import contaminated
from linebeam.llm.queries import BPE_RANKS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "token=abcdefgh", "en", "s", 14), (None, "token=abcdefgh", "en", "s", 14)]
    return d.union(spark.createDataFrame(odd, d.schema)).cache()


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_columns_and_order(docs, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "decontamination", "secrets", "bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_toxic_go(docs, spark):
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = toxicity.score(docs, model, docs.columns).where("predicted = 0").select(*docs.columns)
    assert rows(corpus_pipeline.drop_toxic(spark, docs, SF)) == rows(kept)


def test_one_of_each_group(docs, spark):
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    groups = brute([(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None])
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted({c for _, c in groups.values()})
    assert sum(r["doc_id"] is None for r in kept) == 2


def test_contaminated_go(docs, spark):
    found = {r["key"] for r in contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    kept = corpus_pipeline.drop_contaminated(spark, docs, SF)
    keyed = docs.selectExpr("*", "xxhash64(doc_id, text) as k").collect()
    assert found and rows(kept) == sorted(str(tuple(r)[:-1]) for r in keyed if r["k"] not in found)


def test_secrets_are_replaced(docs, spark):
    out = {r["doc_id"]: r for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect()}
    assert len(out) == docs.select("doc_id").distinct().count()
    for r in docs.collect():
        new = out[r["doc_id"]]
        if not base(r["text"]):
            assert (new["text"], new["n_chars"]) == (r["text"], r["n_chars"])
        else:
            assert not base(new["text"]) and new["n_chars"] == len(new["text"]) and re.search(r"\[(assign|access|hex)\]", new["text"])
            gone = sum(e - s for s, _, _, e in base(r["text"]))
            assert len(new["text"]) <= len(r["text"]) - gone + 12 * len(base(r["text"])) + 12


def test_whole_chain(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(BPE_RANKS), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    current = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        current = spark.createDataFrame(stage(spark, current, SF).collect(), current.schema)
    want = {r["doc_id"]: library.encode_ordinary(r["text"] or "") for r in current.collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_secrets_with_a_column_called_spans(spark):
    docs = spark.createDataFrame([(1, "token=abcdefgh", 14, "mine")], "doc_id long, text string, n_chars long, spans string")
    assert [tuple(r) for r in corpus_pipeline.redact_secrets(spark, docs, SF).collect()] == [(1, "[assign]", 8, "mine")]


def test_extra_columns_pass_all_filters_unchanged(spark):
    """Columns that bear the operators' own names keep their values, and no row is lost to them."""
    names = ["key", "digest", "found_spans", "clean_text", "found_id", "found_rules", "__text", "__key", "Score", "held_out", "component_id", "cid", "item_id"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in stage(spark, plain, SF).collect())
        assert all(r[n] == f"{n}{r['doc_id']}" for r in got for n in names)
