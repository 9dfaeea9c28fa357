"""Fill-in-the-middle texts by displacement scatter.

A text is cut after two unit counts into prefix, middle and suffix, and written
anew as ``<P>prefix<S>suffix<M>middle`` (psm) or ``<S>suffix<P>prefix<M>middle``
(spm). Units are runs of ASCII letters and single other code points. All texts
of a block lie in one byte buffer:

* a scan marks the first byte of every unit; running counts turn the two unit
  counts of a text into byte offsets;
* each of a text's three pieces moves by one distance. A difference array holds
  the change of that distance at the pieces' first bytes, its cumulative sum is
  every byte's shift, and one scatter writes all outputs of the block;
* ``restored`` finds the three marks, whose order the form gives, builds the
  shifts of the way back and gathers the bytes of all texts.

A mark can't arise anywhere else: a text that contains one stays plain, and no
mark begins with a byte that ends another or stands inside it.

Cases: a null or empty text is plain and gives an empty output. A null id draws
as the empty string does. Repeated rows are returned each, with equal outputs. A
very long text is a block of its own and costs a small multiple of its bytes. An
empty table gives no rows. Other columns of the input are not read, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linebeam.llm.common import unused
from linebeam.llm.pieces import BLOCK_CHARS, byte_blocks

# The marks, and the shares of the two draws in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED_PERCENT = 90
SPM_PERCENT = 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARKS = {m: np.frombuffer(m.encode(), np.uint8) for m in (PREFIX, SUFFIX, MIDDLE)}
PLAIN, PSM, SPM = range(3)
FORMS = ("plain", "psm", "spm")


def _draws(doc_id, seed: int):
    """The first four 8-digit groups of the hex sha256 of ``seed:id`` as numbers."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def unit_starts(buf, starts):
    """Whether each byte begins a unit; ``starts``: the texts' first bytes."""
    letter = _LETTER[buf]
    begins = (buf & 0xC0) != 0x80                 # first byte of a code point
    inner = letter[1:] & letter[:-1]
    begins[1:] &= ~inner
    begins[starts[starts < len(buf)]] = True
    return begins


def shifts(size, first, move):
    """The shift of each of ``size`` bytes, from the pieces' first bytes (ascending,
    empty pieces included) and the distance each moves."""
    change = np.bincount(first, np.diff(move, prepend=0), size + 1)
    return np.cumsum(change[:size]).astype(np.int64)


def scatter(buf, starts, cut1, cut2, form):
    """(output bytes, output lengths) of texts ``starts[i]:starts[i + 1]``, cut at two byte offsets."""
    lo, hi = starts[:-1], starts[1:]
    changed, spm = form != PLAIN, form == SPM
    out_len = hi - lo + 9 * changed
    at = np.cumsum(out_len) - out_len
    pre, mid, suf = cut1 - lo, cut2 - cut1, hi - cut2
    # a plain text is moved as one: its pieces follow each other without marks
    to_pre = at + np.where(spm, 6 + suf, 3 * changed)
    to_suf = at + np.where(spm, 3, np.where(changed, 6 + pre, pre + mid))
    to_mid = at + np.where(changed, 9 + pre + suf, pre)
    first = np.stack([lo, cut1, cut2], 1).ravel()
    move = np.stack([to_pre - lo, to_mid - cut1, to_suf - cut2], 1).ravel()
    out = np.empty(int(out_len.sum()), np.uint8)
    out[np.arange(len(buf)) + shifts(len(buf), first, move)] = buf
    for mark, place in ((PREFIX, to_pre), (SUFFIX, to_suf), (MIDDLE, to_mid)):
        out[(place[changed] - 3)[:, None] + np.arange(3)] = _MARKS[mark]
    return out, out_len


def gather(buf, starts, form):
    """(text bytes, text lengths) of outputs ``starts[i]:starts[i + 1]``: the inverse of ``scatter``."""
    lo, hi = starts[:-1], starts[1:]
    changed = form != PLAIN
    lt = np.flatnonzero(buf[:max(len(buf) - 2, 0)] == ord("<"))
    lt = lt[(buf[lt + 2] == ord(">")) & np.isin(buf[lt + 1], [ord("P"), ord("S"), ord("M")])]
    owner = np.searchsorted(starts, lt, "right") - 1
    lt = lt[changed[owner] & (lt + 3 <= hi[owner])].reshape(-1, 3)
    p = s = m = lo
    if len(lt):
        spm = form[changed] == SPM
        p, s, m = lo.copy(), lo.copy(), lo.copy()
        p[changed], s[changed], m[changed] = np.where(spm, lt[:, 1], lt[:, 0]), np.where(spm, lt[:, 0], lt[:, 1]), lt[:, 2]
    pre = np.where(changed, np.where(form == SPM, m, s) - p - 3, hi - lo)
    suf = np.where(changed, np.where(form == SPM, p, m) - s - 3, 0)
    mid = np.where(changed, hi - m - 3, 0)
    size = pre + mid + suf
    at = np.cumsum(size) - size
    first = np.stack([at, at + pre, at + pre + mid], 1).ravel()
    move = np.stack([np.where(changed, p + 3, lo) - at, m + 3 - at - pre, s + 3 - at - pre - mid], 1).ravel()
    return buf[np.arange(int(size.sum())) + shifts(int(size.sum()), first, move)], size


def _strings(flat, lengths):
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat)))


def _cut(part, buf, starts):
    begins = unit_starts(buf, starts)
    at = np.append(np.flatnonzero(begins), len(buf))
    unit0 = np.searchsorted(at[:-1], starts)
    n = np.diff(unit0)
    form, h1, h2 = (part.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "h1", "h2"))
    k = np.stack([h1 % (n + 1), h2 % (n + 1)])
    # the unit after a text's last one begins at the next text's first byte
    cut1, cut2 = (np.where(x < n, at[unit0[:-1] + np.minimum(x, np.maximum(n - 1, 0))], starts[1:]) for x in (k.min(0), k.max(0)))
    return form, n, cut1, cut2


def _transform(columns, chars):
    def run(batches):
        for b in batches:
            for part, buf, starts in byte_blocks(b, "text", chars):
                form, n, cut1, cut2 = _cut(part, buf, starts)
                points = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])   # code points before each byte
                none = form == PLAIN
                out, lengths = scatter(buf, starts, cut1, cut2, form)
                yield pa.RecordBatch.from_arrays([
                    *[part.column(c) for c in columns], pa.array(n, pa.int64()), pa.array(np.array(FORMS)[form], pa.string()),
                    pa.array(points[cut1] - points[starts[:-1]], pa.int64(), mask=none),
                    pa.array(points[cut2] - points[cut1], pa.int64(), mask=none), _strings(out, lengths)],
                    names=[*columns, "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, block_bytes: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h1, h2, h3, h4 = _draws("doc_id", seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    kind = (F.when((text == "") | marked | (h3 % 100 >= CHANGED_PERCENT), PLAIN)
            .when(h4 % 100 < SPM_PERCENT, SPM).otherwise(PSM))
    rows = docs.select("doc_id", h1.alias("h1"), h2.alias("h2"), kind.cast("int").alias("kind"), text.cast("binary").alias("text"))
    kept = docs.select("doc_id").schema.fields[0].dataType.simpleString()
    return rows.mapInArrow(_transform(["doc_id"], block_bytes),
                           f"doc_id {kept}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def _restore(columns, kind, raw, chars):
    def run(batches):
        for b in batches:
            for part, buf, starts in byte_blocks(b, raw, chars):
                text, lengths = gather(buf, starts, part.column(kind).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], _strings(text, lengths)], names=[*columns, "restored"])
    return run


def restored(outputs: DataFrame, block_bytes: int = BLOCK_CHARS) -> DataFrame:
    """``outputs`` of ``fill_in_middle`` with ``restored``, the text rebuilt from output and form alone."""
    kind = F.when(F.col("form") == "psm", PSM).when(F.col("form") == "spm", SPM).otherwise(PLAIN)
    k, raw = (unused(name, outputs.columns) for name in ("kind", "raw"))
    rows = outputs.select("*", kind.cast("int").alias(k), F.coalesce("output", F.lit("")).cast("binary").alias(raw))
    schema = StructType([*outputs.schema.fields, StructField("restored", StringType())])
    return rows.mapInArrow(_restore(outputs.columns, k, raw, block_bytes), schema)


def duckdb_fim(seed: int = 1) -> str:
    """The query over ``documents`` in DuckDB."""
    group = lambda i: f"CAST('0x' || substr(x, {8 * i + 1}, 8) AS BIGINT)"
    marked = " OR ".join(f"contains(t, '{m}')" for m in (PREFIX, SUFFIX, MIDDLE))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units FROM d),
c AS (SELECT *, len(units) AS n, {group(0)} % (len(units) + 1) AS k1, {group(1)} % (len(units) + 1) AS k2,
        CASE WHEN t = '' OR {marked} OR {group(2)} % 100 >= {CHANGED_PERCENT} THEN 'plain'
             WHEN {group(3)} % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(units[1:least(k1, k2)], '') AS pre, array_to_string(units[least(k1, k2) + 1:greatest(k1, k2)], '') AS mid,
        array_to_string(units[greatest(k1, k2) + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || pre || '{SUFFIX}' || suf || '{MIDDLE}' || mid
              ELSE '{SUFFIX}' || suf || '{PREFIX}' || pre || '{MIDDLE}' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
