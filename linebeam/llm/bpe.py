"""Byte-level BPE encoding and decoding by merge replay over a corpus block.

The distinct pre-tokens of a block of documents are laid end to end as byte
tokens. An inverted index maps each mergeable pair (by the rank of its
concatenation) to the positions where it stands; merges are applied in rank
order to all their positions at once, and only pairs with the touched
neighbours enter the index again. Documents then gather the ids of their
pre-tokens. Blocks are independent, so the job is one pass without a shuffle.

Cases: null or empty text: no ids, empty bytes. Long texts and long pre-tokens
take the same path. Unknown ids on decoding raise KeyError. Extra input columns
are not read; repeated rows give equal rows.
"""

from __future__ import annotations

import base64
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.llm.pieces import PieceTable, list_array, text_blocks


def read_ranks(path: str) -> bytes:
    """The rank file (lines ``base64 rank``) as read on the driver; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Ranks:
    """token bytes <-> rank, and the rank of every mergeable pair of ranks."""

    def __init__(self, data: bytes):
        self.rank = {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.size = max(self.bytes_of) + 1
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, r in self.rank.items():
            for i in range(1, len(token)):
                a, b = self.rank.get(token[:i]), self.rank.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()] + [-1], np.int64)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)
        # a token that can join at a lower rank than its own must be merged one place at a time
        low = np.full(self.size, np.iinfo(np.int64).max)
        ranks = self.values[:-1]
        np.minimum.at(low, self.keys[:-1] // self.size, ranks)
        np.minimum.at(low, self.keys[:-1] % self.size, ranks)
        self.early = low < np.arange(self.size)
        # the pairs that give each rank: keys grouped by rank
        order = np.argsort(ranks, kind="stable")
        self.by_rank, self.rank_at = self.keys[:-1][order], np.searchsorted(ranks[order], np.arange(self.size + 1))
        # the tokens' bytes end to end, for decoding
        sizes = np.zeros(self.size, np.int64)
        sizes[list(self.bytes_of)] = [len(t) for t in self.bytes_of.values()]
        self.sizes, self.places = sizes, np.cumsum(sizes) - sizes
        self.blob = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(self.size)), np.uint8)

    def stands(self, rank, left, right):
        """Where a pair of tokens joins at ``rank``."""
        key = left.astype(np.int64) * self.size + right
        ok = np.zeros(len(key), bool)
        for k in self.by_rank[self.rank_at[rank]:self.rank_at[rank + 1]].tolist():
            ok |= key == k
        return ok

    def text(self, ids):
        """(bytes of the ids end to end, bytes per id)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.sizes[ids].all()):
            raise KeyError("an id stands for no token")
        n = self.sizes[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.places[ids] - (ends - n), n)
        at += np.arange(len(at))
        return self.blob[at], n

    def of_pairs(self, left, right):
        """Rank of each pair of tokens, -1 where they don't join."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)


class _Index:
    """rank -> positions, taken out in rank order."""

    def __init__(self):
        self.lists, self.heap = {}, []

    def put(self, ranks, positions):
        ok = ranks >= 0
        ranks, positions = ranks[ok], positions[ok]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for r, p in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
            if r in self.lists:
                self.lists[r].append(p)
            else:
                self.lists[r] = [p]
                heappush(self.heap, r)

    def take(self):
        r = heappop(self.heap)
        parts = self.lists.pop(r)
        pos = np.sort(parts[0] if len(parts) == 1 else np.concatenate(parts))
        return r, pos[np.concatenate([[True], pos[1:] != pos[:-1]])]


def replay(ranks: Ranks, words: list[bytes]):
    """(flat ids, ids per word): every merge applied to all words in rank order."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    n = int(lens.sum())
    tok = np.append(ranks.byte[np.frombuffer(b"".join(words), np.uint8)], np.int32(-1))
    word = np.repeat(np.arange(len(words)), lens)
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    ends = np.cumsum(lens)[lens > 0]
    nxt[ends - 1] = n                                    # n stands for "none"
    prv[(ends - lens[lens > 0])] = n
    index = _Index()
    inner = np.flatnonzero(nxt[:n] < n)
    index.put(ranks.of_pairs(tok[inner], tok[nxt[inner]]), inner)
    while index.heap:
        r, pos = index.take()
        pos = pos[(tok[pos] >= 0) & (nxt[pos] < n)]
        pos = pos[ranks.stands(r, tok[pos], tok[nxt[pos]])]
        if not len(pos):
            continue
        if ranks.early[r]:
            w = word[pos]
            first = np.concatenate([[True], w[1:] != w[:-1]])
            index.put(np.full(np.count_nonzero(~first), r), pos[~first])
            pos = pos[first]
        else:                                            # of overlapping places every other one, from the left
            cont = np.concatenate([[False], nxt[pos[:-1]] == pos[1:]])
            i = np.arange(len(pos))
            start = np.maximum.accumulate(np.where(cont, 0, i))
            pos = pos[(i - start) % 2 == 0]
        right = nxt[pos]
        after = nxt[right]
        tok[pos], tok[right] = r, -1
        nxt[pos] = after
        prv[after] = pos
        before = prv[pos]
        touched = np.concatenate([before[before < n], pos[after < n]])
        index.put(ranks.of_pairs(tok[touched], tok[nxt[touched]]), touched)
    alive = tok[:n] >= 0
    return tok[:n][alive], np.bincount(word[alive], minlength=len(words))


def piece_encoder(ranks: Ranks):
    """Encode pre-tokens: one that is a token itself is that token, the others are replayed together."""
    def encode(pieces):
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        whole = np.fromiter((ranks.rank.get(b, -1) for b in raw), np.int64, len(raw))
        rest = np.flatnonzero(whole < 0)
        flat, counts = replay(ranks, [raw[i] for i in rest])
        n = np.ones(len(raw), np.int64)
        n[rest] = counts
        ends = np.cumsum(n)
        out = np.empty(int(ends[-1]), np.int32)
        starts = ends - n
        out[starts[whole >= 0]] = whole[whole >= 0]
        out[np.repeat(starts[rest] - (np.cumsum(counts) - counts), counts) + np.arange(len(flat))] = flat
        return out, n
    return encode


BLOCK_CHARS = 3_000_000   # a corpus block: its new pre-tokens are replayed together

_TABLES: dict = {}   # one per rank file in a Python worker


def _ranks(key, data):
    if ("ranks", key) not in _TABLES:
        _TABLES["ranks", key] = Ranks(data())
    return _TABLES["ranks", key]


def _encoder(key, pattern, shared, kind, decoded=False):
    def run(batches):
        ranks = _ranks(key, lambda: shared.value)
        table = _TABLES.setdefault(("pieces", key, pattern), PieceTable(piece_encoder(ranks)))
        split = regex.compile(pattern).findall
        for b in batches:
            for part, texts in text_blocks(b, b.num_columns - 1, BLOCK_CHARS):
                flat, counts = table.ids([split(t) for t in texts])
                out = [list_array(flat, counts, pa.int32())]
                if decoded:
                    out.append(_bytes_array(ranks, flat.astype(np.int64), counts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], names=kind)
    return run


def _bytes_array(ranks, ids, per_row):
    """The decoded bytes of rows of ids."""
    raw, n = ranks.text(ids)
    upto = np.concatenate([[0], np.cumsum(n)])
    offsets = upto[np.concatenate([[0], np.cumsum(per_row)])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(per_row), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def _decoder(key, shared, kind):
    def run(batches):
        ranks = _ranks(key, lambda: shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                ids = part.column(b.num_columns - 1)
                per_row = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                out = _bytes_array(ranks, ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), per_row)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.binary()))], names=kind)
    return run


def _named(df: DataFrame, keep, col):
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*keep, F.col(col)), ", ".join(f"`{c}` {fields[c]}" for c in keep)


def _share(spark: SparkSession, path: str):
    data = read_ranks(path)
    return (path, len(data), hash(data)), spark.sparkContext.broadcast(data)


def encode(df: DataFrame, text: str, keep, ranks_path: str, pattern: str, out: str = "ids") -> DataFrame:
    """Columns ``keep`` and ``out`` (array<int>): the BPE ids of ``text``."""
    rows, head = _named(df, keep, text)
    key, shared = _share(df.sparkSession, ranks_path)
    return rows.mapInArrow(_encoder(key, pattern, shared, [*keep, out]), f"{head}, `{out}` array<int>")


def decode(df: DataFrame, ids: str, keep, ranks_path: str, out: str = "bytes") -> DataFrame:
    """Columns ``keep`` and ``out`` (binary): the bytes that ``ids`` stand for."""
    rows, head = _named(df, keep, ids)
    key, shared = _share(df.sparkSession, ranks_path)
    return rows.mapInArrow(_decoder(key, shared, [*keep, out]), f"{head}, `{out}` binary")


def encode_decode(df: DataFrame, text: str, keep, ranks_path: str, pattern: str) -> DataFrame:
    """Columns ``keep``, ids (array<int>) and bytes (binary): the BPE ids of
    ``text`` and what they decode to, in one pass."""
    rows, head = _named(df, keep, text)
    key, shared = _share(df.sparkSession, ranks_path)
    return rows.mapInArrow(_encoder(key, pattern, shared, [*keep, "ids", "bytes"], True), f"{head}, ids array<int>, bytes binary")
