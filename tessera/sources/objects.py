"""Stores of keyed objects as Spark data sources: listings, batch and stream, and a JSON sink that leaves nothing half done.

    register(spark)
    spark.read.format("tessera_objects").option("path", uri).load().where("key LIKE 'reports/%'")
    spark.readStream.format("tessera_objects").option("path", uri).load()
    write_objects(rows, uri)

A listing is planned as one partition for each folder of a level, and read in pages. A condition that keys begin with a
text is answered by the listing itself. Parts of a path that begin with ``_`` or ``.`` aren't listed.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, StringStartsWith, WriterCommitMessage

LISTING = "key string, size long, modified timestamp, version string"
_ARROW = pa.schema([("key", pa.string()), ("size", pa.int64()), ("modified", pa.timestamp("us", tz="UTC")), ("version", pa.string())])
PAGE = 1000
_STAGING = "_staging"


def _hidden(key: str) -> bool:
    return any(part[:1] in ("_", ".") for part in key.split("/"))


@dataclass
class Folder(InputPartition):
    """A folder below the root, with all below it or its own files only; modified after ``since`` up to ``upto``."""

    path: str
    deep: bool
    since: int = -1
    upto: int = 1 << 62

    def __post_init__(self) -> None:
        super().__init__(self.path)


class _Store:
    def __init__(self, uri: str) -> None:
        self.uri = uri

    def open(self) -> tuple[pafs.FileSystem, str]:
        fs, root = pafs.FileSystem.from_uri(self.uri)
        return fs, root.rstrip("/")

    def files(self, path: str, deep: bool) -> Iterator[tuple[str, pafs.FileInfo]]:
        fs, root = self.open()
        for info in fs.get_file_info(pafs.FileSelector(f"{root}/{path}".rstrip("/"), allow_not_found=True, recursive=deep)):
            key = info.path[len(root) + 1 :]
            if info.type == pafs.FileType.File and not _hidden(key):
                yield key, info

    def folders(self, path: str) -> list[str]:
        fs, root = self.open()
        found = fs.get_file_info(pafs.FileSelector(f"{root}/{path}".rstrip("/"), allow_not_found=True))
        return sorted(key for info in found if info.type == pafs.FileType.Directory and not _hidden(key := info.path[len(root) + 1 :]))

    def plan(self, prefix: str, since: int = -1, upto: int = 1 << 62) -> list[Folder]:
        """The first level with several folders below the prefix, a partition each, and the levels above it alone."""
        path, out = prefix.rpartition("/")[0], []
        while True:
            out.append(Folder(path, False, since, upto))
            below = [f for f in self.folders(path) if f.startswith(prefix) or prefix.startswith(f + "/")]
            if len(below) != 1:
                return out + [Folder(f, True, since, upto) for f in below]
            path = below[0]


def _micros(info: pafs.FileInfo) -> int:
    return info.mtime_ns // 1000


class _Listing:
    def __init__(self, options) -> None:
        if "path" not in options:
            raise ValueError("a listing needs a path")
        self.store = _Store(options["path"])
        self.prefix = options.get("prefix", "")
        self.suffixes = tuple(s.strip().lower() for s in options.get("suffixes", "").split(",") if s.strip())

    def pages(self, part: Folder) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for key, info in self.store.files(part.path, part.deep):
            moment = _micros(info)
            if not key.startswith(self.prefix) or not part.since < moment <= part.upto or (self.suffixes and not key.lower().endswith(self.suffixes)):
                continue
            rows.append((key, info.size, moment, hashlib.md5(f"{info.size}:{info.mtime_ns}".encode()).hexdigest()))
            if len(rows) == PAGE:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class _Reader(_Listing, DataSourceReader):
    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, StringStartsWith) and f.attribute == ("key",) and (f.value.startswith(self.prefix) or self.prefix.startswith(f.value)):
                self.prefix = max(self.prefix, f.value, key=len)
            else:
                yield f

    def partitions(self):
        return self.store.plan(self.prefix)

    def read(self, partition):
        yield from self.pages(partition)


class _StreamReader(_Listing, DataSourceStreamReader):
    """Offsets are times of modification; files younger than ``settle`` seconds wait, since others of their time may come."""

    def __init__(self, options) -> None:
        super().__init__(options)
        self.settle = float(options.get("settle", "2"))

    def initialOffset(self) -> dict:
        return {"upto": -1}

    def latestOffset(self) -> dict:
        return {"upto": int((time.time() - self.settle) * 1_000_000)}

    def partitions(self, start: dict, end: dict):
        return self.store.plan(self.prefix, start["upto"], end["upto"])

    def read(self, partition):
        yield from self.pages(partition)

    def commit(self, end: dict) -> None:
        pass


class Objects(DataSource):
    """Options: ``path``, ``prefix``, ``suffixes`` (comma list, any case) and, for streams, ``settle``."""

    @classmethod
    def name(cls) -> str:
        return "tessera_objects"

    def schema(self) -> str:
        return LISTING

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


@dataclass
class _Staged(WriterCommitMessage):
    folder: str
    files: int


class _Writer(DataSourceWriter):
    """Tasks write below a run's staging folder; the commit moves the files of the tasks that count to their keys."""

    def __init__(self, options) -> None:
        self.store = _Store(options["path"])
        self.indent = int(options["indent"]) if options.get("indent") else None
        self.run = uuid.uuid4().hex

    def write(self, rows) -> _Staged:
        fs, root = self.store.open()
        folder, n = f"{_STAGING}/{self.run}/{uuid.uuid4().hex}", 0
        for row in rows:
            if row.key is None or _hidden(row.key) or "" in row.key.split("/"):
                raise ValueError(f"not a key: {row.key!r}")
            path = f"{root}/{folder}/{row.key}"
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            with fs.open_output_stream(path) as out:
                out.write(json.dumps(json.loads(row.payload), ensure_ascii=False, indent=self.indent).encode())
            n += 1
        return _Staged(folder, n)

    def commit(self, messages) -> None:
        fs, root = self.store.open()

        def place(info: pafs.FileInfo, base: str) -> None:
            target = f"{root}/{info.path[len(base) + 1 :]}"
            fs.create_dir(target.rpartition("/")[0], recursive=True)
            fs.move(info.path, target)

        with ThreadPoolExecutor(16) as pool:
            for m in messages:
                if m is not None and m.files:
                    base = f"{root}/{m.folder}"
                    found = [i for i in fs.get_file_info(pafs.FileSelector(base, recursive=True)) if i.type == pafs.FileType.File]
                    list(pool.map(lambda i: place(i, base), found))
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, root = self.store.open()
        path = f"{root}/{_STAGING}/{self.run}"
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            fs.delete_dir(path)


class KeyedJson(DataSource):
    """A sink of (key, payload): one JSON file a key. Options: ``path`` and ``indent``."""

    @classmethod
    def name(cls) -> str:
        return "tessera_keyed"

    def schema(self) -> str:
        return "key string, payload string"

    def writer(self, schema, overwrite: bool):
        return _Writer(self.options)


def register(spark: SparkSession) -> None:
    from ..workers import ship

    ship(spark)
    spark.dataSource.register(Objects)
    spark.dataSource.register(KeyedJson)


def write_objects(rows: DataFrame, uri: str, indent: int | None = None) -> None:
    """One JSON file for each key of (key, payload); of a key's several payloads the greatest counts.

    A write that fails in its tasks leaves no file under any key. A driver lost while it moves files leaves whole files, some
    of them new; the next run overwrites them. Moving costs the driver a call a file, 16 at a time. Null, empty and hidden
    keys, and payloads that aren't JSON, fail the write.
    """
    register(rows.sparkSession)
    one = rows.groupBy("key").agg(F.max("payload").alias("payload"))
    writer = one.write.format("tessera_keyed").mode("append").option("path", uri)
    (writer.option("indent", indent) if indent else writer).save()
