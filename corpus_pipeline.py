"""The training-data pipeline: STAGES applied in order to ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept: toxic documents go; of each near-duplicate group the document with the
smallest id stays; documents that give away a benchmark item go; secrets are
replaced by their kind in brackets; the texts become BPE ids.

Rows without a doc_id pass the near-duplicate stage, since they can't be named
as copies; rows equal in doc_id and text count once there. Null texts pass all
filters. Only the last stage changes the columns.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import functions as F

from linebeam.llm import bpe, secretscan, toxicity
from linebeam.llm.common import read, staged, unused
from linebeam.llm.decontam import contaminated
from linebeam.llm.neardup import near_duplicates
from linebeam.llm.queries import BPE_RANKS

ORACLE_SQL = None
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def bounded_batches(stage):
    """Texts are long: a Python worker is sent ``BATCH_ROWS`` of them at a time, not Arrow's usual number."""
    @wraps(stage)
    def run(spark, docs, sf_dir):
        if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
        return stage(spark, docs, sf_dir)
    return run


@bounded_batches
def drop_toxic(spark, docs, sf_dir):
    return toxicity.accepted(docs, read(spark, sf_dir, "labels"))


@bounded_batches
def drop_near_duplicates(spark, docs, sf_dir):
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    digest = unused("digest", docs.columns)
    named = (docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
             .withColumn(digest, F.xxhash64("text")).dropDuplicates(["doc_id", digest]))
    return named.select(*docs.columns).union(docs.where("doc_id is null"))


@bounded_batches
def drop_contaminated(spark, docs, sf_dir):
    key = unused("key", docs.columns)
    found = contaminated(docs, read(spark, sf_dir, "benchmark")).select(F.col("key").alias(key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), "text"))
    return keyed.join(found, key, "left_anti").select(*docs.columns)


@bounded_batches
def redact_secrets(spark, docs, sf_dir):
    found, clean = (unused(name, docs.columns) for name in ("found_spans", "clean_text"))
    spans = secretscan.secret_spans(docs, keep=docs.columns, name=found)
    text = F.when(F.size(found) > 0, secretscan.redacted(F.col("text"), F.col(found))).otherwise(F.col("text"))
    out = spans.withColumn(clean, text)
    chars = F.when(F.size(found) > 0, F.char_length(clean).cast("bigint")).otherwise(F.col("n_chars"))
    new = {"text": F.col(clean), "n_chars": chars}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


@bounded_batches
def tokenize(spark, docs, sf_dir):
    """doc_id, lang, source, n_tokens, ids, round_trip: whether the ids decode to the text's bytes."""
    path = public_tokenizers.path(BPE_RANKS)
    rows = docs.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256))
    both = bpe.encode_decode(rows, "text", ["doc_id", "lang", "source", "digest"], path, public_tokenizers.PATTERN)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       (F.sha2("bytes", 256) == F.col("digest")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("bpe", tokenize),
]


def run(spark, sf_dir):
    """All stages; what each keeps is written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
