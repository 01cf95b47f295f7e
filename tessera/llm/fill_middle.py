"""Fill-in-the-middle: cut each text into prefix, middle and suffix, and write it with sentinels in another order.

A kernel works on a slice of an Arrow batch at once, on the UTF-8 bytes themselves: a table of 256 byte classes, a mask
of unit ends from each byte's class and that of the byte behind it, cumulative sums less their value at each document's
first byte, and one ``searchsorted`` that takes both cuts of all documents from the ends. The outputs of all documents are then
put together by one gather of bytes. ``restore`` is the way back, in DataFrame functions, from output and form alone.

Units are ``lines`` (with their line end), ``words`` (with the blanks behind them; blanks before the first word are a
unit) or ``chars`` (code points). Which cut and which form a text gets depends on the sha256 of ``<seed>:<doc_id>`` alone, so
reruns and other partitionings agree.

Plan: one map over the documents, no shuffle. A slice has about ``SLICE_BYTES`` of text or one document, and the kernel
some 20 times that in memory.

Edge cases: a null or empty text, and one that contains a sentinel, stays plain: output is the text (null: empty), and
the lengths are null. A null doc_id is hashed as nothing behind the colon. Rows that repeat give equal rows. Columns other
than doc_id and text aren't read. An empty table gives no rows. A text may be of any length up to Arrow's 2 GB.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

PRE, SUF, MID = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20
RATE = 100  # of 100 texts that can be cut
SPM = 50  # of 100 cut texts
_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_BLANK, _END, _INNER, _OTHER = 1, 2, 4, 0


def _classes() -> np.ndarray:
    """The class of each byte: blanks (a line end too), line end, inner byte of a code point."""
    out = np.zeros(256, np.uint8)
    out[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = _BLANK
    out[0x0A] |= _END
    out[0x80:0xC0] = _INNER
    return out


CLASSES = _classes()


def unit_ends(data: np.ndarray, ends: np.ndarray, units: str) -> np.ndarray:
    """A mask of the bytes that end a unit; ``ends`` are the ends of the (non-empty) documents in ``data``."""
    kind = CLASSES[data]
    behind = np.append(kind[1:], np.uint8(_OTHER))
    if units == "lines":
        mask = (kind & _END) > 0
    elif units == "words":
        mask = ((kind & _BLANK) > 0) & ((behind & _BLANK) == 0)
    else:
        mask = (behind & _INNER) == 0
    mask[ends - 1] = True
    return mask


def cut_batch(data: np.ndarray, offsets: np.ndarray, units: str, draws: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """For each text the number of units, the bytes where prefix and middle end, and both parts' code points.

    ``draws`` are two arrays of whole numbers; taken modulo the units plus one, the smaller ends the prefix and the larger
    the middle.
    """
    begin, end = offsets[:-1], offsets[1:]
    mask = unit_ends(data, end[end > begin], units) if len(data) else np.zeros(0, bool)
    count = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])  # units that end before a byte
    chars = np.concatenate([[0], np.cumsum((CLASSES[data] & _INNER) == 0, dtype=np.int32)])
    n = count[end] - count[begin]
    one, two = (d % (n + 1) for d in draws)
    # a cut behind k units: the first byte before which k units of the document, and all of those before it, have ended
    first, second = (np.where(k > 0, np.searchsorted(count, count[begin] + k), begin) for k in (np.minimum(one, two), np.maximum(one, two)))
    return n, first, second, chars[first] - chars[begin], chars[second] - chars[first]


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of all parts (``starts``, ``lengths``) one behind the other."""
    if lengths.sum() > 2 * SLICE_BYTES:  # a long document: places of its bytes would be eight times its size
        return np.concatenate([data[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())])
    places = np.cumsum(lengths) - lengths
    return data[np.repeat(starts - places, lengths) + np.arange(int(lengths.sum()))]


def _form_batch(batch: pa.RecordBatch, units: str, rate: int, spm: int) -> pa.RecordBatch:
    ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
    h1, h2, h3, h4 = (batch.column(i).to_numpy() for i in range(2, 6))
    texts = pa.concat_arrays([texts])  # a slice's own buffers may begin elsewhere
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    begin, end = offsets[:-1], offsets[1:]
    n, first, second, prefix, middle = cut_batch(data, offsets, units, [h1, h2])
    marked = np.zeros(len(texts), bool)
    for sentinel in (PRE, SUF, MID):
        marked |= pc.match_substring(texts, sentinel).to_numpy(zero_copy_only=False)
    plain = (begin == end) | marked | (h3 % 100 >= rate)
    is_spm = ~plain & (h4 % 100 < spm)
    # parts in order of output: sentinel, part, sentinel, part, sentinel, middle; the sentinels stand behind the texts
    marks = np.frombuffer((PRE + SUF + MID).encode(), np.uint8)
    at, size = len(data), len(PRE)
    whole = lambda x, y: np.where(plain, x, y)
    zero = np.zeros(len(texts), np.int64)
    parts = [
        (np.where(is_spm, at + size, at), whole(zero, size)),
        (np.where(plain, begin, np.where(is_spm, second, begin)), whole(end - begin, np.where(is_spm, end - second, first - begin))),
        (np.where(is_spm, at, at + size), whole(zero, size)),
        (np.where(is_spm, begin, second), whole(zero, np.where(is_spm, first - begin, end - second))),
        (np.full(len(texts), at + 2 * size), whole(zero, size)),
        (first, whole(zero, second - first)),
    ]
    starts, lengths = (np.stack([p[i] for p in parts], 1).ravel().astype(np.int64) for i in (0, 1))
    out = gather(np.concatenate([data, marks]), starts, lengths)
    out_offsets = np.concatenate([[0], np.cumsum(lengths.reshape(-1, len(parts)).sum(1))])
    output = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(out_offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    form = pa.array(np.where(plain, "plain", np.where(is_spm, "spm", "psm")).tolist(), pa.string())
    counts = [pa.array(x.astype(np.int64), mask=plain) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), form, *counts, output], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def sliced(batch: pa.RecordBatch, column: int, most: int):
    """Slices of a batch with about ``most`` bytes of text in them, or one row."""
    place = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)) // most
    cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a)


def transform(docs: DataFrame, *, seed: int = 7, units: str = "lines", rate: int = RATE, spm: int = SPM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n units, form (plain, psm or spm), prefix_chars, middle_chars, output.

    ``rate`` of 100 texts are cut, and ``spm`` of 100 of them have the suffix first.
    """
    if units not in ("lines", "words", "chars"):
        raise ValueError(f"units must be lines, words or chars, not {units}")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *draws)

    def kernel(batches):
        for batch in batches:
            for part in sliced(batch, 1, SLICE_BYTES):
                yield _form_batch(part, units, rate, spm)

    return rows.mapInArrow(kernel, _SCHEMA)


def restore(output: Column, form: Column) -> Column:
    """The text of an output: what stands between the sentinels, in the text's order."""
    after = lambda text, sign: F.substring(text, F.locate(sign, text) + len(sign), F.length(text))
    upto = lambda text, sign: F.substring(text, F.lit(1), F.locate(sign, text) - 1)
    inner = F.substring(output, F.lit(1 + len(PRE)), F.length(output))
    psm = F.concat(upto(inner, SUF), after(after(inner, SUF), MID), upto(after(inner, SUF), MID))
    spm = F.concat(upto(after(inner, PRE), MID), after(after(inner, PRE), MID), upto(inner, PRE))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = transform(table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP13_SQL = """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM hashed),
cut AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM drawn),
parts AS (
  SELECT doc_id, t, n, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
