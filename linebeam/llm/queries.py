"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import functions as F

from linebeam.llm import bpe, fim, merkle, quality, secretscan, suffixtree, tokenbin, toxicity
from linebeam.llm.common import read
from linebeam.llm.decontam import contaminated
from linebeam.llm.htmltext import page_text
from linebeam.llm.licences import licence_scan
from linebeam.llm.neardup import duckdb_components, near_duplicates
from linebeam.llm.topk import duckdb_top, top_inner_products
from linebeam.session import scratch_dir

# Parameters of the queries
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
END_ID = 1
QUERY_EVERY = 100
TAMPER_EVERY = 3


def op1_licence_scan(spark, d):
    """Documents as files <source>/<lang>/<thousands of the id>/<id>; one that
    starts with a notice speaks for its folder."""
    docs = read(spark, d, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.col("doc_id").cast("string"))
    found = licence_scan(docs.select("doc_id", path.alias("path"), "text"), "path", "text", keep=["doc_id"], leading_declares=True)
    return found.select("doc_id", "path", "licence", "via", F.round("cosine", 6).alias("cosine"), "from_path")


def op2_toxicity(spark, d):
    return toxicity.toxicity(read(spark, d, "documents"), read(spark, d, "labels"))


def op3_byte_bpe(spark, d):
    path = public_tokenizers.path(BPE_RANKS)
    both = bpe.encode_decode(read(spark, d, "documents"), "text", ["doc_id"], path, public_tokenizers.PATTERN)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def op4_secrets(spark, d):
    return secretscan.secret_report(read(spark, d, "documents"))


def op5_exact_topk(spark, d):
    return top_inner_products(read(spark, d, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


def op6_quality(spark, d):
    return quality.quality(read(spark, d, "documents"), read(spark, d, "labels"))


def op7_html_text(spark, d):
    text = page_text(read(spark, d, "pages"))
    return text.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op8_minhash_neardup(spark, d):
    return near_duplicates(read(spark, d, "documents"))


def op9_decontamination(spark, d):
    found = contaminated(read(spark, d, "documents"), read(spark, d, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "item_windows", "coverage")


def op10_token_binary(spark, d):
    path = scratch_dir(spark, "token-ids")
    tokenbin.write_ids(read(spark, d, "documents"), "doc_id", "text", public_tokenizers.path(WORD_BPE), END_ID, path)
    return tokenbin.read_digests(spark, path)


def op11_merkle_manifest(spark, d):
    """Every third id (by crc32) is checked with a changed text, which must not verify."""
    docs = read(spark, d, "documents")
    head = [merkle.field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0, merkle.leaf_hash(*head, merkle.field(lowered)))
    proved = merkle.merkle_manifest(docs, merkle.leaf_hash(*head, merkle.field("text")), "lang", "doc_id",
                                    {"doc_id": F.col("doc_id"), "tampered": tampered})
    folded = proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("proof")).alias("proof_sha256"),
                           merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_suffix_tree(spark, d):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % suffixtree.FOLDS == suffixtree.HELD_OUT
    return suffixtree.suffix_tree_scores(read(spark, d, "documents"), held)


def op13_fill_in_middle(spark, d):
    both = fim.restored(fim.fill_in_middle(read(spark, d, "documents")))
    return both.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {
    "op1_licence_scan": op1_licence_scan,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_secrets": op4_secrets,
    "op5_exact_topk": op5_exact_topk,
    "op6_quality": op6_quality,
    "op7_html_text": op7_html_text,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_decontamination": op9_decontamination,
    "op10_token_binary": op10_token_binary,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_suffix_tree": op12_suffix_tree,
    "op13_fill_in_middle": op13_fill_in_middle,
}

SQL: dict[str, str] = {
    "op4_secrets": secretscan.duckdb_report(),
    "op5_exact_topk": duckdb_top(every=QUERY_EVERY),
    "op8_minhash_neardup": duckdb_components(),
    "op11_merkle_manifest": merkle.duckdb_manifest(),
    "op13_fill_in_middle": fim.duckdb_fim(),
}
