"""Token-ID output: Arrow stream files of fixed-size-list batches, for random access without copies.

A shard is two Arrow stream files. ``ids-*.arrow`` holds the shard's token stream cut into sequences of
``sequence`` ids: a fixed-size list of the narrowest unsigned integers that hold the vocabulary, and a fixed-size
list of ``sequence / 8`` bytes whose bits, lowest first, mark real ids (only the last sequence of a shard is padded). Every record batch but the last
has ``batch_rows`` sequences and nothing is compressed, so batch ``k`` begins at ``header + k * stride`` and a
reader maps the file and takes sequence ``i`` and its mask in place (``SequenceFile``). ``docs-*.arrow`` lists the shard's
documents with their first place and length in the stream.

Documents are dealt to shards by range of doc_id (at least as many as the session has shuffle partitions, and more
where the input's size asks for it), sorted within, tokenised and written by one map per shard. Files
get the name of their shard and of the attempt; the manifest, written through Spark's committer, names the files of
the attempt that counted, so a lost executor or a repeated task leaves no half shard.

The tokenizer caches pieces between blanks and line ends: normalisation and pre-tokenisation of the tokenizer never
look across such a blank, so the ids of a text are the ids of its pieces in a row. Arrow splits the texts, tells a slice's
pieces apart, finds the known ones and puts their ids together; Python sees the others only. Where samples show that the tokenizer
takes a word and the signs behind it apart, or lowers ASCII, words and signs are cached for themselves, but only if the
word's last letter comes before U+0100: in normal form and lower case that is one letter still. Others (a dotted capital I,
some Hindi and Bengali letters) end in a combining mark then, which goes with the signs; their pieces are taken whole. The cache is two Arrow arrays, the
pieces and their ids, without an object for each, and is emptied at ``CACHE_PIECES`` entries.

Edge cases: a null text is an empty one, and has the end id only. Null doc_ids come first. Rows that repeat a doc_id
stand in order of their texts. An empty table gives no shard and no row. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, shuffle_width, table

SEQUENCE = 2048
BATCH_ROWS = 64
CACHE_PIECES = 1_000_000
SHARD_BYTES = 256 << 20
_UNKNOWN = 1 << 50
END_ID = 2
SLICE_BYTES = 4 << 20
_MARK = "\x01"
_SIGNS = ".,;:!?$%&*#+-=/()[]\""


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PieceEncoder:
    """Ids of whole texts with a cache by piece, equal to ``encode(text, add_special_tokens=False)``."""

    _made: dict[str, PieceEncoder] = {}

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._forget()
        alone, between = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in (_MARK, f"a {_MARK} a"))
        self.mark = alone[0] if len(alone) == 1 and between.count(alone[0]) == 1 else None
        ids = lambda *texts: [i for t in texts for i in self.tokenizer.encode(t, add_special_tokens=False).ids]
        # what the tokenizer does on samples of every sign decides whether words and signs may be known apart
        samples = [(w, s) for w in ("word", "\u00e9t\u00e9", "Z") for s in [*_SIGNS, *(a + b for a in _SIGNS for b in ".,$")]]
        self.parted = all(ids(w + s) == ids(w, s) for w, s in samples)
        self.lowers = all(ids(w) == ids(w.lower()) for w in ("Word", "WORD", "wOrD", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def _forget(self) -> None:
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """One for each Python worker."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _encoded(self, pieces: list[str]) -> dict[str, bytes]:
        # many pieces are one text, with a mark between blanks whose one id comes from nothing else
        out: dict[str, bytes] = {}
        plain = [p for p in pieces if "<|" not in p and _MARK not in p] if self.mark is not None else []
        for at in range(0, len(plain), 4000):
            part = plain[at : at + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([f" {_MARK} ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(ids == self.mark)
            if len(cuts) == len(part) - 1:
                raw, width = ids.tobytes(), self.kind.itemsize
                ends = (cuts * width).tolist()
                out.update(zip(part, map(raw.__getitem__, map(slice, [0, *(e + width for e in ends)], [*ends, len(raw)]))))
        rest = [p for p in pieces if p not in out]
        for piece, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            out[piece] = np.array(e.ids, self.kind).tobytes()
        return out

    def _parts(self, pieces: pa.LargeStringArray) -> pa.LargeStringArray:
        """Two for each piece: a word in lower case and the signs behind it, where the tokenizer takes them so; else the piece and nothing."""
        if self.lowers:
            pieces = pc.if_else(pc.string_is_ascii(pieces), pc.ascii_lower(pieces), pieces)
        lengths = pc.binary_length(pieces)
        if self.parted:
            words = pc.utf8_rtrim(pieces, characters=_SIGNS)
            known = pc.and_(pc.utf8_is_alpha(words), pc.less_equal(pc.utf8_slice_codeunits(words, -1), "\u00ff"))
            lengths = pc.if_else(known, pc.binary_length(words), lengths)
        begins = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, pieces.offset * 8)
        cuts = np.empty(2 * len(pieces) + 1, np.int64)
        cuts[::2] = begins
        cuts[1::2] = begins[:-1] + lengths.to_numpy()
        return pa.LargeStringArray.from_buffers(2 * len(pieces), pa.py_buffer(cuts), pieces.buffers()[2])

    def _ids_of(self, parts: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """The ids of distinct pieces, from the cache or else the tokenizer."""
        places = pc.index_in(parts, value_set=self.known)
        new = places.is_null()
        missing = parts.filter(new)
        if len(missing):
            pieces = missing.to_pylist()
            encoded = self._encoded(pieces)
            places = pc.replace_with_mask(places, new, pa.array(np.arange(len(self.known), len(self.known) + len(pieces), dtype=np.int32)))
            self.known = pa.concat_arrays([self.known, missing])
            self.ids = pa.concat_arrays([self.ids, pa.array([encoded[x] for x in pieces], pa.large_binary())])
        return self.ids.take(places)

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text, as bytes of ``kind``."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        texts = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()), "")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        places = np.asarray(split.offsets) - split.offsets[0].as_py()
        pieces = split.flatten().dictionary_encode()  # this batch's, in a small table
        parts = self._parts(pieces.dictionary).dictionary_encode()
        found = self._ids_of(parts.dictionary).take(parts.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)[::2]  # of a piece: its word's and signs' ids
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends)), found.buffers()[2]]).take(pieces.indices)
        cuts = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, found.offset * 8)[places].tolist()
        data = memoryview(found.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class ShardWriter:
    """Writes one shard's ids file batch by batch; memory is one batch and one document."""

    def __init__(self, sink, kind: np.dtype, sequence: int, batch_rows: int) -> None:
        self.kind, self.sequence, self.batch_rows, self.sink = kind, sequence, batch_rows, sink
        value = pa.uint16() if kind.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([("ids", pa.list_(value, sequence)), ("mask", pa.list_(pa.uint8(), sequence // 8))])
        self.value = value
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.header = self.schema.serialize().size  # written with the first batch
        self.stride = 0
        self.n_ids = 0
        self.held: list[bytes] = []
        self.held_bytes = 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.n_ids += len(ids) // self.kind.itemsize
        full = self.sequence * self.batch_rows * self.kind.itemsize
        if self.held_bytes >= full:
            data = b"".join(self.held)
            for at in range(0, len(data) - full + 1, full):
                self._write(np.frombuffer(data, self.kind, full // self.kind.itemsize, at), None)
            rest = data[len(data) // full * full :]
            self.held, self.held_bytes = [rest], len(rest)

    def _write(self, ids: np.ndarray, valid: int | None) -> None:
        mask = np.packbits(np.arange(len(ids)) < (len(ids) if valid is None else valid), bitorder="little")
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x, t), n) for x, t, n in ((ids, self.value, self.sequence), (mask, pa.uint8(), self.sequence // 8))]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.stride = self.stride or self.sink.tell() - self.header

    def close(self) -> None:
        data = np.frombuffer(b"".join(self.held), self.kind)
        if len(data):
            padded = np.zeros(-(-len(data) // self.sequence) * self.sequence, self.kind)
            padded[: len(data)] = data
            self._write(padded, len(data))
        self.writer.close()


_MANIFEST = "shard int, folder string, ids_file string, docs_file string, first_doc long, n_docs long, n_ids long, header long, stride long"
_SHARD = pa.schema([(name, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[kind]) for name, kind in (x.split() for x in _MANIFEST.split(", "))])


def _slices(batches):
    """The rows of batches in parts of about ``SLICE_BYTES`` of text, twice that and one text at most: what is encoded at once."""
    held, size = [], 0
    for batch in batches:
        place = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64)) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            if end > begin:
                held.append(batch.slice(begin, end - begin))
                size += held[-1].nbytes
                if size >= SLICE_BYTES:
                    yield pa.concat_batches(held)
                    held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _writer(folder: str, tokenizer_path: str, end_id: int | None, sequence: int, batch_rows: int):
    def write(batches):
        from pyspark import TaskContext

        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        encoder = PieceEncoder.of(tokenizer_path)
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid.uuid4().hex[:12]}.arrow"
        end = b"" if end_id is None else np.array([end_id], encoder.kind).tobytes()
        out = None
        n_docs, first, width = 0, None, encoder.kind.itemsize
        schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64())])
        for batch in _slices(batches):
            if out is None:
                fs.create_dir(root, recursive=True)
                sink, docs_sink = fs.open_output_stream(f"{root}/ids-{name}"), fs.open_output_stream(f"{root}/docs-{name}")
                out, docs = ShardWriter(sink, encoder.kind, sequence, batch_rows), pa.ipc.new_stream(docs_sink, schema)
                first = batch.column(0)[0].as_py()
            places, lengths = [], []
            for ids in encoder.encode(batch.column(1)):
                ids += end
                places.append(out.n_ids)
                lengths.append(len(ids) // width)
                out.add(ids)
            n_docs += batch.num_rows
            docs.write_batch(pa.RecordBatch.from_arrays([batch.column(0), pa.array(places, pa.int64()), pa.array(lengths, pa.int64())], schema=schema))
            pa.default_memory_pool().release_unused()  # the worker lives on, and what Arrow freed would stay with it
        if out is not None:
            out.close()
            docs.close()
            sink.close()
            docs_sink.close()
            row = [shard, folder, f"ids-{name}", f"docs-{name}", first, n_docs, out.n_ids, out.header, out.stride]
            yield pa.RecordBatch.from_pylist([dict(zip(_SHARD.names, row))], _SHARD)

    return write


def write_tokens(docs: DataFrame, folder: str, *, tokenizer_path: str | None = None, end_id: int | None = END_ID, sequence: int = SEQUENCE, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Encode ``docs`` (doc_id, text) to shards under ``folder`` in ascending order; returns the manifest.

    The manifest has a row for each shard, with ``start``, the ids in all shards before it.
    """
    if sequence % 8:
        raise ValueError("sequence must be a multiple of 8, as masks are whole bytes")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # Spark's estimate, without a pass
    shards = max(shuffle_width(spark), -(-size // SHARD_BYTES) if size < _UNKNOWN else 0)
    dealt = rows.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    dealt.mapInArrow(_writer(f"{folder}/shards", tokenizer_path or public_tokenizer(), end_id, sequence, batch_rows), _MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The shards of ``folder`` with ``start``; one row a shard, so the running sum is the driver's.

    It goes back as an Arrow table: a list would be read by Python workers of another kind, which stay beside those that encode.
    """
    shards, start = [], 0
    for row in sorted(spark.read.parquet(f"{folder}/manifest").collect(), key=lambda r: r["shard"]):
        shards.append(row.asDict() | {"start": start})
        start += row["n_ids"]
    return spark.createDataFrame(pa.Table.from_pylist(shards, _SHARD.append(pa.field("start", pa.int64()))))


def marked(mask: np.ndarray) -> np.ndarray:
    """The bits of a mask as booleans, one an id."""
    return np.unpackbits(mask, bitorder="little").view(bool)


class SequenceFile:
    """Random access to the sequences of one ids file, and their masks, by its fixed stride, without copying them."""

    def __init__(self, path: str, header: int, stride: int, batch_rows: int = BATCH_ROWS) -> None:
        self.map = pa.memory_map(path)
        self.schema = pa.ipc.open_stream(self.map).schema
        self.header, self.stride, self.batch_rows = header, stride, batch_rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        self.map.seek(self.header + i // self.batch_rows * self.stride)
        batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.map), self.schema)
        k = i % self.batch_rows
        n = self.schema.field("ids").type.list_size
        return batch.column(0).values.slice(k * n, n).to_numpy(), batch.column(1).values.slice(k * n // 8, n // 8).to_numpy()


def _reader(batches):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for shard in batch.to_pylist():
            fs, root = pyarrow.fs.FileSystem.from_uri(shard["folder"])
            with fs.open_input_stream(f"{root}/{shard['ids_file']}") as ids_source, fs.open_input_stream(f"{root}/{shard['docs_file']}") as docs_source:
                stream = iter(pa.ipc.open_stream(ids_source))
                held = np.zeros(0, np.uint32)
                for docs in pa.ipc.open_stream(docs_source):
                    crcs = []
                    for n in docs.column(2).to_pylist():
                        crc = 0
                        while n > len(held):  # a document may go on in the next batch
                            crc, n = zlib.crc32(held.tobytes(), crc), n - len(held)
                            part = next(stream)
                            valid = marked(part.column(1).values.to_numpy())
                            held = part.column(0).values.to_numpy()[valid].astype("<u4")
                        crcs.append(zlib.crc32(held[:n].tobytes(), crc))
                        held = held[n:]
                    starts = docs.column(1).to_numpy() + shard["start"]
                    yield pa.RecordBatch.from_arrays([docs.column(0), pa.array(starts, pa.int64()), docs.column(2), pa.array(crcs, pa.int64())], names=names)


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 of its ids as little-endian uint32."""
    shards = manifest.repartition(shuffle_width(manifest.sparkSession))
    return shards.mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tokens")
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), folder))
