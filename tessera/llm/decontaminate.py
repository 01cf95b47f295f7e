"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over token windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased: ASCII digits and letters
and everything beyond ASCII. On UTF-8 bytes that is one ``bytes.translate`` and one ``split``, because every byte
of a character beyond ASCII is 0x80 or more. A window is ``window`` consecutive words of a benchmark item; an item
of fewer words, but not none, is one window of its own length.

Each word becomes its id in the benchmark's vocabulary, 0 if it isn't there. Only positions whose whole window is
in the vocabulary are hashed (a rolling polynomial over uint64 in numpy), looked up in the sorted hash set, and
verified word by word against the exact window before they count.

The scan is one map over the documents: no shuffle, so copies, hot sources and common passages cost no more than
their own rows. The benchmark goes to the executors as a broadcast of at most ``max_block_bytes`` of text, which takes at most
about 25 times that in memory if all its words differ, and 4 times in common prose (16 bytes a word and 120 a distinct word); a larger
benchmark is dealt into blocks of that size, scanned one after the other, with what each document has gathered so
far written between the passes.

Edge cases: a null or empty text has no words and no hits. An item that is null or has no word has no window. Items
with the same id count once; an item with a null id marks words but is not listed. Repeated document rows each get
a row. Columns other than the id and the text pass through untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, stored, table

WINDOW = 10
MAX_BLOCK_BYTES = 8 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_SLICE = 256


def words_of(raw: bytes) -> list[bytes]:
    """The normalised words of UTF-8 text."""
    return raw.translate(_WORD_BYTES).split()


class WindowSet:
    """The windows of a block of benchmark items, by length: hashes in order, and where in the items each window begins.

    That is 16 bytes a word besides the vocabulary (about 120 a distinct word).
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[str | None] = []
        words, begins, found = [], [0], {}
        for item, raw in items:
            ids = words_of(raw)
            if not ids:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in ids], np.int32)
            length = min(window, len(ids))
            # a window that an item repeats is listed once
            _, first = np.unique(np.lib.stride_tricks.sliding_window_view(ids, length), axis=0, return_index=True)
            found.setdefault(length, []).append(begins[-1] + first)
            self.items.append(item)
            words.append(ids)
            begins.append(begins[-1] + len(ids))
        self.words = np.concatenate(words) if words else np.zeros(0, np.int32)
        self.ends = np.array(begins[1:], np.int64)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, starts in found.items():
            at = np.concatenate(starts)
            value = np.zeros(len(at), np.uint64)
            for k in range(length):
                value = value * _BASE + self.words[at + k].astype(np.uint64)
            order = np.argsort(value, kind="stable")
            self.windows[length] = value[order], at[order].astype(np.int32)

    def holding(self, length: int, low: int, high: int, ids: np.ndarray) -> list[str | None]:
        """The items of the listed windows ``low`` to ``high`` that are these words."""
        starts = self.windows[length][1][low:high]
        same = (self.words[starts[:, None] + np.arange(length)] == ids).all(axis=1)
        return [self.items[i] for i in np.searchsorted(self.ends, starts[same], "right")]

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, int, set[str], np.ndarray | None]]:
        """For each text: its words, its hit words, the items found, and which words are hit (None if none)."""
        look, ids, ends, counts = self.vocabulary.get, [], [], []
        total = 0
        for raw in texts:
            words = words_of(raw) if raw else []
            counts.append(len(words))
            ids.append(np.fromiter((look(w, 0) for w in words), np.int32, len(words)))
            total += len(words) + 1  # a 0 keeps windows within a text
            ends.append(total)
        flat = np.zeros(total, np.int32)
        at = 0
        for one in ids:
            flat[at : at + len(one)] = one
            at += len(one) + 1
        hit = np.zeros(total, bool)
        items: dict[int, set[str]] = {}
        known = np.concatenate(([0], np.cumsum(flat != 0)))
        starts = np.array([0, *ends[:-1]])
        for length, (hashes, _) in self.windows.items():
            if total < length:
                continue
            whole = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(whole):
                continue
            value = np.zeros(len(whole), np.uint64)
            for k in range(length):
                value = value * _BASE + flat[whole + k].astype(np.uint64)
            low, high = np.searchsorted(hashes, value), np.searchsorted(hashes, value, "right")
            for k in np.flatnonzero(low < high):
                p = whole[k]
                found = self.holding(length, low[k], high[k], flat[p : p + length])
                if found:
                    hit[p : p + length] = True
                    doc = int(np.searchsorted(starts, p, "right")) - 1
                    items.setdefault(doc, set()).update(x for x in found if x is not None)
        out = []
        for doc, n in enumerate(counts):
            mask = hit[starts[doc] : starts[doc] + n]
            n_hit = int(mask.sum())
            out.append((n, n_hit, items.get(doc, set()), mask if n_hit else None))
        return out


def without_spans(raw: bytes, mask: np.ndarray) -> bytes:
    """The text without its runs of hit words; a run goes from its first to its last character."""
    kept, at, begun, last = [], 0, None, 0
    for hit, word in zip(mask, _WORD.finditer(raw)):
        if hit:
            begun = word.start() if begun is None else begun
            last = word.end()
        elif begun is not None:
            kept.append(raw[at:begun])
            at, begun = last, None
    if begun is not None:
        kept.append(raw[at:begun])
        at = last
    kept.append(raw[at:])
    return b"".join(kept)


def benchmark_blocks(benchmark: DataFrame, max_block_bytes: int = MAX_BLOCK_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of at most ``max_block_bytes`` of text (or of one item), streamed through the driver."""
    block, size = [], 0
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), "text")
    for row in rows.toLocalIterator():
        raw = row["text"].encode("utf-8", "surrogatepass")
        if block and size + len(raw) > max_block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], raw))
        size += len(raw)
    yield block


def _texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def report(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, item_ids.

    With one block of benchmark text this is one pass. With more, hit positions and items are carried from pass to
    pass and written between them.
    """
    spark = docs.sparkSession
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<string>"
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    carry, last_path = False, None
    blocks = benchmark_blocks(benchmark, max_block_bytes)
    block = next(blocks)
    while True:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(WindowSet(block, window))
        if following is None:
            return state.mapInArrow(_reporter(shared, carry), schema)
        state = state.mapInArrow(_collector(shared, carry), "doc_id long, text string, hit binary, item_ids array<string>")
        state, path = stored(state, "decontaminate")
        if last_path:
            drop_path(spark, last_path)
        carry, last_path, block = True, path, following


def _merged(windows: WindowSet, batch: pa.RecordBatch, carry: bool) -> list[tuple[int, np.ndarray | None, set[str]]]:
    out = []
    before = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())) if carry else [(None, None)] * batch.num_rows
    for (n, _, items, mask), (hit, listed) in zip(windows.scan(_texts(batch, "text")), before):
        if hit:
            old = np.unpackbits(np.frombuffer(hit, np.uint8), count=n).astype(bool)
            mask = old if mask is None else mask | old
        out.append((n, mask, items | set(listed or ())))
    return out


def _reporter(shared, carry: bool):
    def scan(batches):
        windows = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows = _merged(windows, batch, carry)
                hits = [0 if mask is None else int(mask.sum()) for _, mask, _ in rows]
                items = [sorted(x) for _, _, x in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([n for n, _, _ in rows], pa.int64()),
                        pa.array(hits, pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                        pa.array([h > 0 for h in hits], pa.bool_()),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "item_ids"],
                )

    return scan


def _collector(shared, carry: bool):
    def scan(batches):
        windows = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows = _merged(windows, batch, carry)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([None if mask is None else np.packbits(mask).tobytes() for _, mask, _ in rows], pa.binary()), pa.array([sorted(x) for _, _, x in rows], pa.list_(pa.string()))],
                    names=["doc_id", "text", "hit", "item_ids"],
                )

    return scan


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", window: int = WINDOW, max_block_bytes: int = MAX_BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated documents (``remove="documents"``) or without the hit spans (``"spans"``).

    All columns of ``docs`` come back in their order and types. Blocks of a large benchmark are applied in turn; spans
    are marked in the whole text by every block, and cut once at the end.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    spans, hit = remove == "spans", f"hit_{uuid.uuid4().hex}"
    out = docs.select("*", F.lit(None).cast("binary").alias(hit)) if spans else docs
    for block in benchmark_blocks(benchmark, max_block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet(block, window))
        out = out.mapInArrow(_marker(shared) if spans else _remover(shared), out.schema)
    return out.mapInArrow(_cutter, docs.schema) if spans else out


def _remover(shared):
    def scan(batches):
        windows = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                texts = _texts(batch, "text")
                masks = [mask for _, _, _, mask in windows.scan(texts)]
                yield batch.filter(pa.array([mask is None for mask in masks], pa.bool_()))

    return scan


def _marker(shared):
    """Adds the hits of a block of the benchmark to those in the last column."""

    def scan(batches):
        windows = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                packed = [None if mask is None else np.packbits(mask) for _, _, _, mask in windows.scan(_texts(batch, "text"))]
                old = [None if x is None else np.frombuffer(x, np.uint8) for x in batch.columns[-1].to_pylist()]
                hits = [y if x is None else x if y is None else x | y for x, y in zip(packed, old)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([None if x is None else x.tobytes() for x in hits], batch.schema.types[-1])], schema=batch.schema)

    return scan


def _cutter(batches):
    """Cuts the spans that the last column marks, and drops it."""
    for batch in batches:
        k = batch.schema.get_field_index("text")
        texts = zip(_texts(batch, "text"), batch.columns[-1].to_pylist())
        new = pa.array([t if x is None else without_spans(t, np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool)) for t, x in texts], pa.binary()).cast(batch.schema.types[k])
        yield pa.RecordBatch.from_arrays([new if i == k else c for i, c in enumerate(batch.columns[:-1])], names=batch.schema.names[:-1])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + least(len(w), {WINDOW}) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
),
hits AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""
