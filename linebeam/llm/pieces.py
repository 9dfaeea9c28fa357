"""Encode texts through a table of distinct pieces.

A text splits into pieces (pre-tokens or words) that are encoded apart from each
other, so each distinct piece is encoded once; a text's ids are the gathered ids
of its pieces. The table lives in a Python worker, across its tasks, and is
emptied when it holds more than ``PIECES`` pieces."""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES = 300_000        # pieces a worker keeps
BLOCK_CHARS = 2_000_000  # texts are handled in blocks of about so many characters


class PieceTable(dict):
    """piece -> row; ``encode(list of pieces)`` gives (flat ids, ids per piece)."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.empty()

    def empty(self):
        self.clear()
        self.flat, self.starts, self.lens = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, new):
        flat, counts = self.encode(new)
        base = len(self.flat)
        self.update(zip(new, range(len(self), len(self) + len(new))))
        self.starts = np.concatenate([self.starts, base + np.cumsum(counts) - counts])
        self.lens = np.concatenate([self.lens, counts])
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, docs):
        """(flat ids, ids per document) of documents given as lists of pieces."""
        if len(self) > PIECES:
            self.empty()
        pieces = list(chain.from_iterable(docs))
        new = list(set(pieces).difference(self.keys()))
        if new:
            self.add(new)
        rows = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        n = self.lens[rows]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = self.flat[np.repeat(self.starts[rows] - ends[:-1], n) + np.arange(ends[-1])]
        at = np.cumsum([0] + [len(d) for d in docs])
        return out, ends[at[1:]] - ends[at[:-1]]


def text_blocks(batch, column, chars=BLOCK_CHARS):
    """Slices of an Arrow batch of about ``chars`` bytes of text, with their
    texts (null: empty); only one slice is turned into Python strings at a time.
    A longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    upto, lo = np.cumsum(sizes, dtype=np.int64), 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + chars, "right")))
        part = batch.slice(lo, hi - lo)
        yield part, [t or "" for t in part.column(column).to_pylist()]
        lo = hi


def list_array(flat, counts, kind):
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, kind))


def byte_blocks(batch, column, size=BLOCK_CHARS):
    """Slices of an Arrow batch of about ``size`` bytes in a binary column, each with its bytes
    as one array and the places where its values start (one more: the end). Null: empty."""
    batch = pa.RecordBatch.from_arrays([pc.fill_null(batch.column(c), b"") if n == column else batch.column(c)
                                        for c, n in enumerate(batch.schema.names)], names=batch.schema.names)
    col = batch.column(column)
    _, ends, data = col.buffers()
    wide = pa.types.is_large_binary(col.type)
    ends = np.frombuffer(ends, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + size, "right")) - 1)
        yield batch.slice(lo, hi - lo), data[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo]
        lo = hi
