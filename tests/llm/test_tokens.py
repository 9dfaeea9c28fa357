import base64
import functools
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linebeam.llm import bpe, queries, tokenbin
from linebeam.llm.pieces import PieceTable
from linebeam.session import scratch_dir

SF = "/root/testdata/sf0.001"
RANKS = P.path(queries.BPE_RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return _ranks()


def test_replay_equals_library(library, ranks):
    import regex
    rnd = random.Random(3)
    texts = ["", "a" * 4001, " " * 500 + "x", "abcabcab" * 90, "é" * 301, "漢字かな" * 40, "🙂👍🏽" * 9, "<|endoftext|> 12345"]
    texts += ["".join(rnd.choice("abcdeéß 漢\n1,") for _ in range(200)) for _ in range(200)]
    table, split = PieceTable(bpe.piece_encoder(ranks)), regex.compile(P.PATTERN).findall
    flat, counts = table.ids([split(t) for t in texts])
    ends = np.cumsum(counts)
    for t, hi, n in zip(texts, ends, counts):
        assert flat[hi - n:hi].tolist() == library.encode_ordinary(t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abct he\n", max_size=40), min_size=1, max_size=5))
def test_replay_round_trip(texts):
    r = _ranks()
    words = [t.encode() for t in texts if t]
    flat, counts = bpe.replay(r, words)
    assert b"".join(r.bytes_of[i] for i in flat.tolist()) == b"".join(words)


@functools.cache
def _ranks():
    return bpe.Ranks(bpe.read_ranks(RANKS))


def test_encode_decode_edge_cases(spark, documents, library):
    ids = bpe.encode(documents, "text", ["doc_id", "ids"], RANKS, P.PATTERN, out="tokens")
    back = bpe.decode(ids, "tokens", ["doc_id", "ids", "tokens"], RANKS)
    texts = {r["ids"]: r["text"] for r in documents.collect()}
    rows = back.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["tokens"] == library.encode_ordinary(texts[r["ids"]] or "")
        assert bytes(r["bytes"]) == (texts[r["ids"]] or "").encode()
    assert bpe.encode(documents.limit(0), "text", ["doc_id"], RANKS, P.PATTERN).collect() == []


def test_op3_whole_table(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op3_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def _expected(rows):
    model = Tokenizer.from_file(P.path(queries.WORD_BPE))
    out, start = [], 0
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op10_whole_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(map(tuple, queries.op10_token_binary(spark, SF).collect())) == _expected(rows)


def test_token_files_edge_cases(spark, documents):
    path = scratch_dir(spark, "ids")
    tokenbin.write_ids(documents, "doc_id", "text", P.path(queries.WORD_BPE), 1, path)
    got = sorted(map(tuple, tokenbin.read_digests(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r["doc_id"] for r in documents.collect()), key=lambda i: (i is not None, i))
    named = {r[0]: r[2:] for r in _expected((r["doc_id"], r["text"]) for r in documents.collect())}
    assert all(named[i] == tuple(rest) for i, _, *rest in got)
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    full = {r["start"]: r["ids"] for r in tokenbin.read_ids(spark, path).collect()}
    assert all(len(full[s]) == n and zlib.crc32(np.array(full[s], "<u4").tobytes()) == c for _, s, n, c in got)
    empty = scratch_dir(spark, "none")
    tokenbin.write_ids(documents.limit(0), "doc_id", "text", P.path(queries.WORD_BPE), 1, empty)
    assert tokenbin.read_digests(spark, empty).collect() == []


def test_words_with_the_separator_and_odd_spaces():
    model = Tokenizer.from_file(P.path(queries.WORD_BPE))
    table = tokenbin.WordTable(model)
    texts = ["a\x01b \x01 c", "x y\x1cz w", "It's 12,5 Ünï ſt <|endoftext|>x", "", " \n", "don't'll", "e\u0301E\u0301 1\u0301 .'s ''s a'b.c”.d “x”…9٣b",
             "Ab1c2%%%d's '1' x'9 K İi ΑΣ ς", "q" * 700 + " " + "q" * 700, "\ud7ff\ue000 \u00a0a\u2003b", "A.B,C;d1e\x7f\x00f"]
    flat, counts = table.ids(texts)
    ends = np.cumsum(counts)
    for t, hi, n in zip(texts, ends, counts):
        assert flat[hi - n:hi].tolist() == model.encode(t, add_special_tokens=False).ids


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700))
def test_elias_fano(gaps):
    v = np.cumsum(gaps) if gaps else np.empty(0, np.int64)
    code = tokenbin.EliasFano.from_bytes(tokenbin.EliasFano.build(v).to_bytes())
    assert code.values().tolist() == v.tolist()
    assert [code[i] for i in range(len(code))] == v.tolist()


def test_latin_words_skip_normaliser_and_separators(monkeypatch):
    """Words of lower-case Latin-1 letters reach the library with spaces between, with the ids of whole texts."""
    model = Tokenizer.from_file(P.path(queries.WORD_BPE))
    texts = ["The año garçon straße, naïve x÷y Éclair éclair it's a1b", "ÿß œuvre é ñé façade", "", "ends in öl", "über", "漢字 mañana×3"]
    table, others, encode = tokenbin.WordTable(model), [], tokenbin.WordTable.encode
    monkeypatch.setattr(tokenbin.WordTable, "encode", lambda self, words: others.extend(words) or encode(self, words))
    flat, counts = table.ids(texts)
    ends = np.cumsum(counts)
    for t, hi, n in zip(texts, ends, counts):
        assert flat[hi - n:hi].tolist() == model.encode(t, add_special_tokens=False).ids
    assert others and not [w for w in others if w and not set(w) - set(tokenbin.LATIN + "abcdefghijklmnopqrstuvwxyz")]
