"""Language-model scores from a probabilistic suffix tree over words.

A state is a context of up to ``max_context`` words. Its next-word distribution is
smoothed by its parent's, the context without its oldest word:
p(x | s) = (c(s, x) + prior * p(x | parent)) / (c(s) + prior), down to the root's
add-one word frequencies. A context is tested once it has ``min_count`` training
occurrences, and retained if its parent is and its distribution diverges: the mean
log ratio of its probabilities to its parent's over its occurrences, each with that
occurrence itself left out of both counts, is ``min_divergence`` nats or more. A
token is scored by the longest suffix of what precedes it in its document that is a
state. All distributions sum to one over the training words and one unknown word.

1. One pass turns texts into blocks of whole documents: a dictionary of 64-bit word
   hashes and the tokens as places in it. Blocks are bucketed, so the later steps
   move answers to them and never move a block.
2. Counting is an exchange: a block sends its distinct word sequences with its own
   training counts, dealt by hash; the receiver adds up and answers each block, in
   the order asked. So a frequent sequence costs one number a block, however often
   it occurs, and no table of the corpus is held anywhere as a whole or broadcast.
   Words go first; a longer sequence is asked only where its context has
   ``min_count`` occurrences, since no other is used, and where the answers for
   shorter ones don't settle it.
3. The log ratios of contexts are summed by the same exchange, as integers; the
   answer is whether a context is retained.
4. The blocks score their documents with the answers.

Cases: null or wordless text: the end token alone. A null doc_id learns and is
scored like others (held_out false). Repeated rows are each learnt from and each
returned. A very long text is in one block with what fits beside it; its memory is
a small multiple of its bytes. Without training rows every token has probability 1
(the one unknown word). An empty table gives no rows. Other columns aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from linebeam.llm.bytehash import Powers, hashes_of
from linebeam.llm.common import Buckets
from linebeam.llm.pieces import byte_blocks
from linebeam.llm.shingles import mix


@dataclass(frozen=True)
class Tree:
    """The model's parameters."""
    max_context: int = 2           # words of the longest context
    min_count: int = 16            # training occurrences of a context that is tested
    prior: float = 256.0           # weight of the parent's distribution, in occurrences
    min_divergence: float = 0.02   # nats per occurrence


BLOCK_TOKENS = 1_000_000
BUCKET_BYTES = 32 << 20  # text of the blocks that one task visits, about
MAX_BUCKETS = 100_000    # as many as Spark takes; beyond that, tasks visit more
PART_KEYS = 1 << 20      # sequences that a receiver adds up, about
PAIR_ROUNDS = 2          # pairs are most of what is asked: in so many rounds, so that a part of it is on disk at a time
FOLDS, HELD_OUT = 7, 2

UNITS = 1e2              # log ratios are summed in hundredths, so their order doesn't matter
END = np.uint64(0x9E3779B97F4A7C15)   # stands for the end of a document
_STEP = np.uint64(0xD6E8FEB86659FD93)  # odd

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_INT, _LONG, _RAW = pa.int32(), pa.int64(), pa.binary()
BLOCKS = pa.schema({"block": _LONG, "n_tokens": _LONG, "doc_ids": pa.list_(_LONG), "held": pa.list_(pa.bool_()),
                    "lengths": _RAW, "words": _RAW, "tokens": _RAW})
ASKED = pa.schema({"level": _INT, "part": _LONG, "block": _LONG, "keys": _RAW, "amounts": _RAW})
ANSWERS = pa.schema({"level": _INT, "part": _LONG, "block": _LONG, "amounts": _RAW, "n_distinct": _LONG, "total": _LONG})
SCORES = pa.schema({"doc_id": _LONG, "held_out": pa.bool_(), "n_tokens": _LONG, "n_known": _LONG,
                    "base_score": pa.float64(), "score": pa.float64()})


def pack(values) -> bytes:
    """Integers as compressed byte planes: small numbers leave the high planes empty."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _signed(values):
    """Signed integers as unsigned ones, near zero first."""
    return ((values << 1) ^ (values >> 63)).view(np.uint64)


def _unsigned(values):
    return (values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)


def token_hashes(buf, starts, powers, chunk=4_000_000):
    """(hashes, tokens per text) of texts ``starts[i]:starts[i + 1]``: words with A-Z
    lowered, then one end each. Words are hashed in chunks of the bytes."""
    word = ~_SPACE[buf]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = starts[1:-1][starts[1:-1] < len(buf)]
    first[inner] = word[inner]
    edge = inner[inner > 0]
    last[edge - 1] = word[edge - 1]
    first, last = np.flatnonzero(first), np.flatnonzero(last)
    lowered, hashes, lo = _LOWER[buf], [], 0
    while lo < len(first):
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + chunk)))
        base = first[lo]
        hashes.append(hashes_of(lowered[base:last[hi - 1] + 1], first[lo:hi] - base, last[lo:hi] - base, powers))
        lo = hi
    n = np.diff(np.searchsorted(first, starts))
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    return np.insert(flat, np.cumsum(n), END), n + 1


def _block_row(number, ids, held, hashes, lengths):
    words, code, count = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")               # frequent words get small places
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return _rows([(number, len(hashes), ids, held, pack(lengths), words[order].tobytes(), pack(place[code]))], BLOCKS)


def _block_maker(size):
    def run(batches):
        number, powers = TaskContext.get().partitionId() << 32, Powers()
        ids, held, hashes, lengths, tokens = [], [], [], [], 0
        for b in batches:
            for part, buf, starts in byte_blocks(b, "text"):
                h, n = token_hashes(buf, starts, powers)
                hashes.append(h)
                lengths.append(n)
                ids += part.column("doc_id").to_pylist()
                held += part.column("held").to_pylist()
                tokens += len(h)
                if tokens >= size:
                    yield _block_row(number, ids, held, np.concatenate(hashes), np.concatenate(lengths))
                    number, ids, held, hashes, lengths, tokens = number + 1, [], [], [], [], 0
        if ids:
            yield _block_row(number, ids, held, np.concatenate(hashes), np.concatenate(lengths))
    return run


class Block:
    """A block's tokens, and what the answers say of each token's sequences.

    Level k is the sequence of a token and the k tokens before it. ``tested[k]``:
    the tokens whose context of k words has ``min_count`` occurrences; ``count[k]``:
    the training counts of their sequences, by token. A count that the level below
    settles isn't asked: a sequence whose last k words occur once in training is
    there itself or occurs nowhere. ``asked[k]``: the other tokens; ``keys[k]``: the
    distinct hashes of their sequences, ascending; ``at[k]``: each one's place there."""

    def __init__(self, row, tree, answers=None):
        self.tree = tree
        self.ids, self.held = row["doc_ids"][0].as_py(), np.array(row["held"][0].as_py(), bool)
        self.lengths = unpack(row["lengths"][0].as_py()).astype(np.int64)
        self.hashes = np.frombuffer(row["words"][0].as_py(), np.uint64)[unpack(row["tokens"][0].as_py()).astype(np.int64)]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.hashes)) - np.repeat(self.starts, self.lengths)   # in its document
        self.train = ~np.repeat(self.held, self.lengths)
        self.answers = answers or {}
        self.gram, self.tested, self.asked, self.keys, self.at, self.count = [], [], [], [], [], []

    def level(self, k):
        """Sets up level k; the levels below must have their answers."""
        gram, count = self.hashes, np.zeros(len(self.hashes), np.int64)
        tested = asked = np.arange(len(gram))
        if k:
            with np.errstate(over="ignore"):
                gram = mix(self.gram[k - 1] * _STEP + np.roll(self.hashes, k) + np.uint64(k))
            below = self.count[k - 1]
            enough = self.place >= k
            enough[1:] &= below[:-1] >= self.tree.min_count      # its context, the sequence that ends one token before
            tested = np.flatnonzero(enough)
            once = below[tested] <= self.train[tested]
            count[tested[once]] = self.train[tested[once]]
            asked = tested[~once]
        keys, at = np.unique(gram[asked], return_inverse=True)
        for name, value in zip(("gram", "tested", "asked", "keys", "at"), (gram, tested, asked, keys, at)):
            getattr(self, name).append(value)
        if k in self.answers or not len(keys):               # a block that asked nothing has no answers
            count[asked] = self.answer(k)[at]
            self.count.append(count)

    def answer(self, level):
        return self.answers.get(level, np.empty(0, np.int64))

    def levels(self, upto):
        for k in range(upto + 1):
            self.level(k)
        return self

    def own_counts(self, k):
        return np.bincount(self.at[k][self.train[self.asked[k]]], minlength=len(self.keys[k]))

    def contexts(self, k):
        """(tokens whose context of k words is tested, the distinct context hashes, places among them, counts)."""
        tokens = self.tested[k]
        keys, at = np.unique(self.gram[k - 1][tokens - 1], return_inverse=True)
        return tokens, keys, at, self.count[k - 1][tokens - 1]


def _probabilities(block, total, words, left_out):
    """Per level (tokens, their probability given k words); level 0 for all tokens.
    ``left_out``: how often a token is taken out of the counts that score it (0 or 1)."""
    c0 = block.count[0]
    p = (c0 + 1 - left_out) / np.maximum(total + words + 1 - left_out, 1)
    out = [p]
    for k in range(1, block.tree.max_context + 1):
        tokens, _, _, seen = block.contexts(k)
        mine = (block.count[k][tokens] - left_out[tokens] + block.tree.prior * p[tokens]) / (seen - left_out[tokens] + block.tree.prior)
        p = p.copy()
        p[tokens] = mine
        out.append(p)
    return out


def _asked_rows(number, level, keys, amounts, bits, turn=0, rounds=1):
    """The block's requests of one level, a row per receiver; keys ascend, so receivers
    do. In round ``turn`` of ``rounds``, those of one share of the hashes."""
    ends = [np.uint64(((1 << 64) - 1) * t // rounds) for t in (turn, turn + 1)]
    share = slice(np.searchsorted(keys, ends[0], "right") if turn else 0, np.searchsorted(keys, ends[1], "right"))
    keys, amounts = keys[share], amounts[share]
    if not len(keys):
        return
    part = (keys >> np.uint64(64 - bits)) if bits else np.zeros(len(keys), np.uint64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(keys)]])
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield level, int(part[lo]), number, pack(np.diff(keys[lo:hi], prepend=np.uint64(0))), pack(_signed(amounts[lo:hi].astype(np.int64)))


def _rows(found, schema, kind=pa.RecordBatch):
    """Tuples as Arrow columns."""
    columns = zip(*found) if found else [[] for _ in schema]
    return kind.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _ask_words(tree, bits):
    """Requests that need no answers: the words."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                block = Block(row, tree).levels(0)
                yield _rows(list(_asked_rows(row["block"][0].as_py(), 0, block.keys[0], block.own_counts(0), bits)), ASKED)
    return run


def _ask_longer(number, block, bits, k, turn, rounds):
    block.levels(k)
    return _rows(list(_asked_rows(number, k, block.keys[k], block.own_counts(k), bits, turn, rounds)), ASKED, pa.Table)


def _ask_divergence(number, block, bits, total, words):
    """Requests for the contexts' log ratios, each training token left out of its own counts."""
    p = _probabilities(block.levels(block.tree.max_context), total, words, block.train.astype(np.int64))
    found = []
    for k in range(1, block.tree.max_context + 1):
        tokens, keys, at, _ = block.contexts(k)
        learnt = block.train[tokens]
        tokens, at = tokens[learnt], at[learnt]
        # what each occurrence has over the least divergence: the context is retained if the sum isn't negative
        over = np.rint(UNITS * (np.log(p[k][tokens] / p[k - 1][tokens]) - block.tree.min_divergence))
        found += _asked_rows(number, block.tree.max_context + k, keys, np.bincount(at, over, len(keys)), bits)
    return _rows(found, ASKED, pa.Table)


def _scores(block, total, words):
    p = _probabilities(block.levels(block.tree.max_context), total, words, np.zeros(len(block.hashes), np.int64))
    base = np.log10(p[0])
    score, in_state = base.copy(), np.ones(len(base), bool)
    for k in range(1, block.tree.max_context + 1):
        tokens, _, at, _ = block.contexts(k)
        state = np.zeros(len(base), bool)
        state[tokens] = block.answer(block.tree.max_context + k)[at] > 0
        in_state &= state                                    # a state's parent is one
        score[in_state] = np.log10(p[k][in_state])
    each = lambda v: np.add.reduceat(v, block.starts)
    return pa.Table.from_arrays([
        pa.array(block.ids, pa.int64()), pa.array(block.held), pa.array(block.lengths), pa.array(each((block.count[0] > 0).astype(np.int64))),
        pa.array(each(base)), pa.array(each(score))], schema=SCORES)


def _add_up(last_count: int, asked: pa.Table) -> pa.Table:
    """The receiver: the sum of every key's amounts, to each block in the order it
    asked; of sums that aren't counts (levels above ``last_count``), whether they are 0 or more."""
    keys = [np.cumsum(unpack(raw.as_py()), dtype=np.uint64) for raw in asked["keys"]]
    amounts = np.concatenate([_unsigned(unpack(raw.as_py())) for raw in asked["amounts"]])
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, amounts)
    level, part = asked["level"][0].as_py(), asked["part"][0].as_py()
    if level > last_count:
        sums = (sums >= 0).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    found = [(level, part, b.as_py(), pack(_signed(sums[at[end - len(k):end]])), 0, 0) for b, k, end in zip(asked["block"], keys, ends)]
    found[0] = (*found[0][:4], int((sums > 0).sum()), int(sums.sum()))     # the part's own numbers go with one of its rows
    return _rows(found, ANSWERS, pa.Table)


def _answer(asked: DataFrame, tree: Tree, answers: Buckets) -> None:
    """Adds up what is asked, and puts the answers where the blocks are."""
    def add_up(group):
        return _add_up(tree.max_context, group)
    found = asked.groupBy("level", "part").applyInArrow(add_up, from_arrow_schema(ANSWERS))
    answers.add(found.repartition(answers.buckets, "block"))


def _visit(blocks: DataFrame, answers: DataFrame, tree: Tree, work, schema: pa.Schema) -> DataFrame:
    """``work(number, block)`` for every block with its answers, one block at a time."""
    def run(left, right):
        if not left.num_rows:
            return schema.empty_table()
        found = {}
        for a in sorted(right.select(["level", "part", "amounts"]).to_pylist(), key=lambda a: (a["level"], a["part"])):
            found.setdefault(a["level"], []).append(_unsigned(unpack(a["amounts"])))
        return work(left["block"][0].as_py(), Block(left, tree, {k: np.concatenate(v) for k, v in found.items()}))
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, from_arrow_schema(schema))


def suffix_tree_scores(docs: DataFrame, held: Column, tree: Tree = Tree(), block_tokens: int = BLOCK_TOKENS,
                       part_keys: int = PART_KEYS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every
    text; the rows for which ``held`` isn't true are learnt from. Scores are log10
    probabilities; ``base_score`` is that of the tree's root alone."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held, F.lit(False)).alias("held"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, 1 + text_bytes // BUCKET_BYTES)
    blocks, answers = (Buckets(docs.sparkSession, "block", buckets, name) for name in ("blocks", "answers"))
    try:
        blocks.add(rows.mapInArrow(_block_maker(block_tokens), from_arrow_schema(BLOCKS)))
        tokens = blocks.rows().agg(F.sum("n_tokens")).first()[0] or 0
        bits = max(0, int(tokens // part_keys).bit_length())     # receivers grow with the corpus
        _answer(blocks.rows().mapInArrow(_ask_words(tree, bits), from_arrow_schema(ASKED)), tree, answers)
        seen = answers.rows().where("level = 0").agg(F.sum("total"), F.sum("n_distinct")).first()
        total, words = (int(x or 0) for x in seen)

        def visit(work, schema, below=2 * tree.max_context + 1):
            return _visit(blocks.rows(), answers.rows().where(F.col("level") < below), tree, work, schema)
        for k in range(1, tree.max_context + 1):
            rounds = min(PAIR_ROUNDS if k == 1 else 1, 1 << bits)
            for turn in range(rounds):
                ask = lambda number, block, k=k, turn=turn, rounds=rounds: _ask_longer(number, block, bits, k, turn, rounds)
                _answer(visit(ask, ASKED, k), tree, answers)
        _answer(visit(lambda number, block: _ask_divergence(number, block, bits, total, words), ASKED), tree, answers)
        scored = visit(lambda number, block: _scores(block, total, words), SCORES)
        return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
    finally:
        blocks.forget()
        answers.forget()
