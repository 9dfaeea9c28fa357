"""Token-id files with Elias-Fano document boundaries.

Documents are range-partitioned and sorted by id; each partition (a shard)
streams its texts through the tokenizer and emits segments: one concatenated id
array plus the Elias-Fano code of the documents' end offsets. Segments are rows
of a Parquet table, so Spark's commit protocol makes each shard appear exactly
once even when a task is run again, on any store that Spark can write.

Segment row: shard, segment, n_docs, first (ids before it in the shard), n_ids,
doc_ids, bounds (``EliasFano.to_bytes``), ids (little-endian unsigned, ``width``
bytes each: 2 where the vocabulary allows, else 4).

The tokenizer encodes words apart from each other, so each distinct word is
encoded by the library once per Python worker and found again by its 64-bit hash.
Words of lower-case Latin-1 letters alone reach it with spaces between, as they
are; all others are normalised and split by it, with a separator between.

Cases: null or empty text: the end id alone. Null ids come first, equal ids
follow each other in the order of a text hash, then of the text. A text longer
than a segment makes a segment of its own. An empty table gives no rows.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linebeam.llm.bytehash import Powers, hashes_of
from linebeam.llm.pieces import text_blocks

SEGMENT_IDS = 1 << 20   # a segment closes once it holds so many ids
SAMPLE = 256            # every so many set bits their place is kept for select

SEGMENTS = ("shard int, segment int, n_docs int, first bigint, n_ids bigint, width int, "
            "doc_ids array<bigint>, bounds binary, ids binary")


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / n) bits a value:
    low bits packed, high parts in unary; ``select`` reads any value through
    sampled places without a table of offsets."""

    def __init__(self, n, low_bits, low, high):
        self.n, self.l, self.low, self.high = n, low_bits, low, high
        bits = np.unpackbits(high, bitorder="little")
        self.samples = np.flatnonzero(bits)[::SAMPLE]

    @classmethod
    def build(cls, values):
        x = np.asarray(values, np.int64)
        n = len(x)
        low_bits = max(0, int(x[-1] // n).bit_length() - 1) if n else 0
        if low_bits:
            parts = (x[:, None] >> np.arange(low_bits)) & 1
            low = np.packbits(parts.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.empty(0, np.uint8)
        places = (x >> low_bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"))

    def _low(self, i):
        at = i * self.l
        if not self.l:
            return 0
        raw = int.from_bytes(self.low[at >> 3:(at + self.l + 7) >> 3].tobytes(), "little")
        return raw >> (at & 7) & ((1 << self.l) - 1)

    def select(self, i):
        """The place of the i-th set bit of the high part."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte = place >> 3
        here = int(self.high[byte]) >> (place & 7) << (place & 7)
        while (c := here.bit_count()) <= left:
            left -= c
            byte += 1
            here = int(self.high[byte])
        for _ in range(left):
            here &= here - 1
        return byte * 8 + (here & -here).bit_length() - 1

    def __getitem__(self, i):
        return (self.select(i) - i) << self.l | self._low(i)

    def __len__(self):
        return self.n

    def values(self):
        """The whole sequence."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        x = (places - np.arange(self.n)).astype(np.int64) << self.l
        if self.l:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.l].reshape(self.n, self.l)
            x |= bits.astype(np.int64) @ (1 << np.arange(self.l))
        return x

    def to_bytes(self):
        return np.array([self.n, self.l, len(self.low), len(self.high)], "<u8").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data):
        n, low_bits, a, b = np.frombuffer(data, "<u8", 4).tolist()
        raw = np.frombuffer(data, np.uint8, offset=32)
        return cls(n, low_bits, raw[:a], raw[a:a + b])


SEPARATOR = "\x01"   # encoded as one id of its own; a word that holds it is encoded alone
WORDS = 2_000_000    # words a Python worker keeps
RECENT = 60_000      # new words are sorted into the table when they are more than so many
BLOCK_CHARS = 400_000  # texts are looked up in blocks whose arrays stay in a core's cache
LONG = 255           # a word of more bytes is told from others by its text, not by its hash

# byte classes: white space, ASCII letter, apostrophe, other ASCII mark, digit, byte of a non-ASCII character
_SPACE, _LETTER, _QUOTE, _MARK, _DIGIT, _OTHER = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123)]] = _LETTER
_CLASS[39] = _QUOTE
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _OTHER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# lower-case letters of Latin-1, which stay as they are in lower-casing and composition, and their two bytes in UTF-8
LATIN = "".join(map(chr, [0xdf, *range(0xe0, 0xf7), *range(0xf8, 0x100)]))
_LATIN_LEAD, _LATIN_NEXT = 0xc3, np.zeros(256, bool)
_LATIN_NEXT[[c.encode("utf-8")[1] for c in LATIN]] = True
# where the tokenizer always starts anew: after white space, between ASCII
# letters and marks, and at ASCII digits; never beside an apostrophe (it may
# begin a contraction) or a non-ASCII byte (it may combine with its neighbour)
_CUT = np.zeros((6, 6), bool)
_CUT[_SPACE, 1:] = True
_CUT[_LETTER, _MARK] = _CUT[_MARK, _LETTER] = _CUT[_DIGIT, _DIGIT] = True
_CUT[_DIGIT, [_LETTER, _QUOTE, _MARK]] = _CUT[[_LETTER, _QUOTE, _MARK], _DIGIT] = True


def words_of(texts):
    """(bytes with ASCII lowered, first, last, text): the words of a block of texts by their byte ranges."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    block = _LOWER[np.frombuffer(b"\n".join(raw), np.uint8)]
    kind = _CLASS[block]
    before = np.concatenate([[np.uint8(_SPACE)], kind[:-1]]) if len(kind) else kind
    first = np.flatnonzero(_CUT[before, kind])
    after = np.concatenate([kind[1:], [np.uint8(_SPACE)]]) if len(kind) else kind
    last = np.flatnonzero((kind != _SPACE) & ((after == _SPACE) | _CUT[kind, after]))
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), first, "right")
    return block, first, last, text


def _merged(*parts):
    """(flat ids, ids per word) of words that were encoded in parts: their places, flat ids and ids per word."""
    counts = np.empty(sum(len(at) for at, _, _ in parts), np.int64)
    for at, _, n in parts:
        counts[at] = n
    starts, flat = np.cumsum(counts) - counts, np.empty(int(counts.sum()), np.int32)
    for at, ids, n in parts:
        flat[np.repeat(starts[at] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
    return flat, counts


class WordTable:
    """Ids of distinct words by their hash; each is encoded by the library once."""

    def __init__(self, tokenizer):
        self.tokenizer, self.powers = tokenizer, Powers()
        self.bare = type(tokenizer).from_str(tokenizer.to_str())
        self.bare.normalizer = None                     # for words of ASCII: they are lower-cased, and composed as they are
        self.apart = self._told_apart()
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        (self.separator,) = tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.empty()

    def _told_apart(self):
        """(tokenizer for words of ASCII letters, by id whether it ends a word); None where the given tokenizer
        changes or splits a word of ``LATIN`` letters, or its ids don't show where words end."""
        split, normal = self.bare.pre_tokenizer, self.tokenizer.normalizer
        pieces = [split.pre_tokenize_str(w) if split else [] for w in (string.ascii_lowercase, LATIN)]
        suffix = getattr(self.bare.model, "end_of_word_suffix", None)
        if not suffix or any(len(p) != 1 for p in pieces) or pieces[0][0][0] != string.ascii_lowercase or normal and normal.normalize_str(LATIN) != LATIN:
            return None
        from tokenizers.pre_tokenizers import WhitespaceSplit
        plain = type(self.bare).from_str(self.bare.to_str())
        plain.pre_tokenizer = WhitespaceSplit()
        vocabulary = plain.get_vocab()
        ends = np.zeros(max(vocabulary.values()) + 1, bool)
        ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        return plain, ends

    def empty(self):
        # sorted hashes with their words' rows: the table, and the words met since it was last sorted
        self.levels = [(np.empty(0, np.uint64), np.empty(0, np.int32))] * 2
        self.flat, self.starts, self.lens, self.n, self.m = np.empty(1 << 20, np.int32), np.empty(1 << 18, np.int32), np.empty(1 << 18, np.int32), 0, 0

    def _room(self, words, ids):
        """Arrays with room for more words and ids; they double, so words cost a constant each."""
        while self.n + words > len(self.lens):
            self.starts, self.lens = np.concatenate([self.starts, self.starts]), np.concatenate([self.lens, self.lens])
        while self.m + ids > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])

    def _find(self, hashes):
        """The rows of sorted hashes, -1 where a word is new."""
        rows = np.full(len(hashes), -1, np.int32)
        for known, at_row in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                rows = np.where(known[at] == hashes, at_row[at], rows)
        return rows

    def encode(self, words):
        """(flat ids, ids per word): one library call takes many words with a separator between."""
        groups = ([], [], [])                            # ASCII, others, those with the separator
        for i, w in enumerate(words):
            groups[2 if SEPARATOR in w else 0 if w.isascii() else 1].append(i)
        kinds = [self._joined(self.bare, [words[i] for i in groups[0]]), self._joined(self.tokenizer, [words[i] for i in groups[1]])]
        odd = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast([words[i] for i in groups[2]], add_special_tokens=False)]
        kinds.append((np.concatenate(odd) if odd else np.empty(0, np.int32), np.fromiter(map(len, odd), np.int64, len(odd))))
        return _merged(*[(np.array(at, np.int64), *kind) for at, kind in zip(groups, kinds)])

    def _joined(self, tokenizer, words):
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        ids = np.array(tokenizer.encode_batch_fast([f" {SEPARATOR} ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(ids == self.separator)
        if len(cuts) != len(words) - 1:
            raise ValueError("the separator's id occurs in other words")
        return ids[ids != self.separator], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1

    def encode_apart(self, tokenizer, block, first, last):
        """``encode`` for words of letters that are as the normaliser leaves them, given by their places in ``block``."""
        if not len(first):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        n = last - first + 2                             # with a space behind
        ends = np.cumsum(n)
        at = np.repeat(first - (ends - n), n)
        at += np.arange(len(at))
        at[ends - 1] -= 1                                # stays inside the block
        joined = block[at]
        joined[ends - 1] = 32
        text = joined.tobytes().decode("utf-8")
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        cuts = np.flatnonzero(self.apart[1][ids])
        if len(cuts) != len(first):                      # a word whose end has no id
            return self.encode(text.split())
        return ids, np.diff(cuts, prepend=-1)

    def encode_new(self, block, first, last):
        """``encode`` for words given by their places in ``block``."""
        kinds = np.full(len(first), 2)
        if self.apart:
            letter = _CLASS[block] == _LETTER
            lead = np.flatnonzero(block[:-1] == _LATIN_LEAD)
            lead = lead[_LATIN_NEXT[block[lead + 1]]]
            latin = letter.copy()
            latin[lead] = latin[lead + 1] = True
            for kind, good in ((1, latin), (0, letter)):
                bad = np.concatenate([[0], np.cumsum(~good)])
                kinds[bad[last + 1] == bad[first]] = kind
        at = [np.flatnonzero(kinds == k) for k in range(3)]
        parts = [self.encode_apart(t, block, first[i], last[i]) for t, i in zip((self.apart[0], self.bare), at)] if self.apart else []
        odd = [block[a:b + 1].tobytes().decode("utf-8", "surrogatepass") for a, b in zip(first[at[2]].tolist(), last[at[2]].tolist())]
        return _merged(*[(i, *part) for i, part in zip(at if parts else at[2:], [*parts, self.encode(odd)])])

    def add(self, hashes, flat, counts):
        """Rows of new words, given by sorted hashes with their ids and how many each has."""
        self._room(len(hashes), len(flat))
        rows = np.arange(self.n, self.n + len(hashes), dtype=np.int32)
        self.starts[rows] = self.m + np.cumsum(counts) - counts
        self.lens[rows] = counts
        self.flat[self.m:self.m + len(flat)] = flat
        self.n, self.m = self.n + len(hashes), self.m + len(flat)
        (table, table_rows), (recent, recent_rows) = self.levels
        at = np.searchsorted(recent, hashes)
        recent, recent_rows = np.insert(recent, at, hashes), np.insert(recent_rows, at, rows)
        if len(recent) > RECENT:
            at = np.searchsorted(table, recent)
            table, table_rows = np.insert(table, at, recent), np.insert(table_rows, at, recent_rows)
            recent, recent_rows = recent[:0], recent_rows[:0]
        self.levels = [(table, table_rows), (recent, recent_rows)]
        return rows

    def ids(self, texts):
        """(flat ids, ids per text). A text that holds an added token's string goes to the library whole."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        if not whole:
            return self._ids(texts)
        given = dict(zip(whole, self.tokenizer.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)))
        flat, counts = self._ids(["" if i in given else t for i, t in enumerate(texts)])
        parts = np.split(flat, np.cumsum(counts)[:-1])
        parts = [np.array(given[i].ids, np.int32) if i in given else x for i, x in enumerate(parts)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))

    def _ids(self, texts):
        if self.n > WORDS:
            self.empty()
        block, first, last, text = words_of(texts)
        if not len(first):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        h = hashes_of(block, first, last, self.powers)
        word = lambda i: block[first[i]:last[i] + 1].tobytes()
        for i in np.flatnonzero(last - first >= LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(word(i))
        found, back = np.unique(h, return_inverse=True)    # without the first places, whose sort has to be stable
        rows = self._find(found)
        new = rows < 0
        if new.any():
            sample = np.empty(len(found), np.int64)
            sample[back] = np.arange(len(h))
            at = sample[new]
            rows[new] = self.add(found[new], *self.encode_new(block, first[at], last[at]))
        rows = rows[back]
        n = self.lens[rows]
        ends = np.cumsum(n)
        where = np.repeat(self.starts[rows] - (ends - n), n)
        where += np.arange(len(where))
        return self.flat[where], np.bincount(text, weights=n, minlength=len(texts)).astype(np.int64)


_TABLES: dict = {}   # one per vocabulary in a Python worker


def _segment(shard, segment, first, ids, counts, docs, width):
    return pa.RecordBatch.from_arrays(
        [pa.array([x], k) for x, k in zip(
            [shard, segment, len(docs), first, len(ids), width, docs,
             EliasFano.build(np.cumsum(counts)).to_bytes(), ids.astype(f"<u{width}").tobytes()],
            [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()])],
        names=["shard", "segment", "n_docs", "first", "n_ids", "width", "doc_ids", "bounds", "ids"])


def _writer(key, shared, end_id):
    def run(batches):
        from tokenizers import Tokenizer
        if key not in _TABLES:
            tokenizer = Tokenizer.from_str(shared.value)
            _TABLES[key] = WordTable(tokenizer), (2 if tokenizer.get_vocab_size() <= 1 << 16 else 4)
        table, width = _TABLES[key]
        shard, segment, first = TaskContext.get().partitionId(), 0, 0
        ids, counts, docs, size = [], [], [], 0
        for b in batches:
            for part, texts in text_blocks(b, 1, BLOCK_CHARS):
                flat, n = table.ids(texts)
                ids.append(np.insert(flat, np.cumsum(n), end_id))
                counts.append(n + 1)
                docs += part.column(0).to_pylist()
                size += len(ids[-1])
                if size >= SEGMENT_IDS:
                    yield _segment(shard, segment, first, np.concatenate(ids), np.concatenate(counts), docs, width)
                    segment, first = segment + 1, first + size
                    ids, counts, docs, size = [], [], [], 0
        if docs:
            yield _segment(shard, segment, first, np.concatenate(ids), np.concatenate(counts), docs, width)
    return run


def write_ids(df: DataFrame, doc_id: str, text: str, tokenizer_json: str, end_id: int, path: str) -> None:
    """Encode every text (``tokenizer_json``: a file of the tokenizers library),
    append ``end_id``, and write the segments in ascending ``doc_id`` order to ``path``."""
    with open(tokenizer_json, encoding="utf-8") as f:
        model = f.read()
    shared = df.sparkSession.sparkContext.broadcast(model)   # as large as the vocabulary file
    rows = (df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
            .select("doc_id", "text"))
    rows.mapInArrow(_writer((tokenizer_json, len(model)), shared, end_id), SEGMENTS).write.parquet(path)


def _reader(bases):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard, first, width, docs, bounds, raw = (b.column(c)[i].as_py() for c in ("shard", "first", "width", "doc_ids", "bounds", "ids"))
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                ends = EliasFano.from_bytes(bounds).values()
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(starts + (bases.value[shard] + first), pa.int64()),
                    _ids_column(ids, ends)], names=["doc_id", "start", "ids"])
    return run


def _ids_column(ids, ends):
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int64()), pa.array(ids.astype(np.int64))).cast(pa.list_(pa.int64()))


def _shard_starts(spark: SparkSession, path: str) -> dict:
    """Ids before each shard. One number per shard, at most as many as shuffle partitions, comes to the driver."""
    sizes = spark.read.parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    bases, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["shard"]):
        bases[r["shard"]] = total
        total += r["n"]
    return bases


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): the documents of the files at ``path``."""
    bases = spark.sparkContext.broadcast(_shard_starts(spark, path))
    return spark.read.schema(SEGMENTS).parquet(path).mapInArrow(_reader(bases), "doc_id bigint, start bigint, ids array<bigint>")


def _digests(bases):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard, first, width, docs, bounds, raw = (b.column(c)[i].as_py() for c in ("shard", "first", "width", "doc_ids", "bounds", "ids"))
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                ends = EliasFano.from_bytes(bounds).values()
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs, pa.int64()), pa.array(starts + (bases.value[shard] + first), pa.int64()),
                    pa.array(ends - starts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents of the files at ``path``."""
    bases = spark.sparkContext.broadcast(_shard_starts(spark, path))
    return spark.read.schema(SEGMENTS).parquet(path).mapInArrow(
        _digests(bases), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
