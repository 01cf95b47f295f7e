"""The ledger as a folder of Parquet, and incremental runs over a stream of references.

A run of Structured Streaming reads new reference files once (``availableNow``), drops what the ledger holds, processes
the rest and then marks it: write before mark, so a run that breaks off repeats work and never loses it.

A mark writes its own records to a fresh folder and then commits a numbered entry of ``log/`` that names it, so that it
costs what is new. An entry is made whole beside the log and renamed to the next free number, which one writer only can
have; the file system must refuse to rename onto a file, as HDFS does at once. ``add`` entries count beside the earlier
ones, an ``only`` entry (of ``compact`` and ``clear``) stands for all before it. Every ``COMPACT`` entries the ledger is
written whole; what the last rewrite but one replaced is deleted, so that readers of the last state go on.

A ledger that is missing is empty; an entry that can't be understood, a folder that is gone and a Parquet file that can't
be read have no records: their work is done again. A null ``document_key`` is a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import corpus as C

SCHEMA = "document_key string, source_name string, processed_at timestamp, code_version string, department string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
COMPACT = 32


class Ledger:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("log").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _log(self) -> list[tuple[int, str, str]]:
        """(number, kind, folder) of the entries by number; one that can't be understood has an empty kind."""
        if not self.fs.exists(self._path("log")):
            return []
        names = sorted(f.getPath().getName() for f in self.fs.listStatus(self._path("log")))
        out = []
        for name in names:
            if name.isdigit():
                kind, _, folder = self._text(f"log/{name}").partition(" ")
                out.append((int(name), kind, folder) if kind in ("add", "only") and folder else (int(name), "", ""))
        return out

    def _text(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8", "replace").strip()
        finally:
            stream.close()

    def _commit(self, number: int, entry: str) -> bool:
        """Make ``entry`` the one of that number; False if there is one already."""
        made = self._path(f"log/.{uuid.uuid4().hex}")
        out = self.fs.create(made, False)
        out.write(bytearray(entry.encode()))
        out.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.fs.makeQualified(made), self.fs.makeQualified(self._path(f"log/{number:012d}")), options)
            return True
        except Py4JJavaError as error:
            self.fs.delete(made, False)
            if "FileAlreadyExistsException" not in str(error.java_exception.getClass().getName()):
                raise
            return False

    def _written(self, rows: DataFrame) -> str:
        name = f"v-{uuid.uuid4().hex}"
        rows.select(*COLUMNS).write.parquet(f"{self.folder}/{name}")
        return name

    def _rows(self, log: list[tuple[int, str, str]]) -> DataFrame:
        start = max((i for i, (_, kind, _) in enumerate(log) if kind == "only"), default=0)
        counted = {folder: n for n, kind, folder in log[start:] if kind and self.fs.exists(self._path(folder))}
        if not counted:
            return self.spark.createDataFrame([], SCHEMA)
        numbers = F.create_map(*[F.lit(x) for pair in counted.items() for x in pair])
        rows = self.spark.read.schema(SCHEMA).option("ignoreCorruptFiles", True).parquet(*[f"{self.folder}/{f}" for f in counted])
        rows = rows.withColumn("number", F.element_at(numbers, F.regexp_extract("_metadata.file_path", "/(v-[0-9a-f]{32})/[^/]*$", 1)))
        last = rows.groupBy("document_key").agg(F.max(F.struct("number", "processed_at", *[c for c in COLUMNS if c not in ("document_key", "processed_at")])).alias("r"))
        return last.select(*[F.col("document_key") if c == "document_key" else F.col(f"r.{c}").alias(c) for c in COLUMNS])

    def read(self) -> DataFrame:
        """All records, one a key: that of the last mark."""
        return self._rows(self._log())

    def mark(self, new: DataFrame) -> None:
        """Record processed references; one record a key, the newer in place of the older."""
        entry, log = f"add {self._written(new)}", self._log()
        number = log[-1][0] + 1 if log else 1
        while not self._commit(number, entry):
            number += 1
        if sum(kind == "add" for _, kind, _ in log[max((i for i, e in enumerate(log) if e[1] == "only"), default=0) :]) + 1 >= COMPACT:
            self.compact()

    def _replace(self, make: Callable[[DataFrame], DataFrame]) -> bool:
        """One try to write the ledger anew; False if another writer was faster."""
        log = self._log()
        name = self._written(make(self._rows(log)))
        if not self._commit(log[-1][0] + 1 if log else 1, f"only {name}"):
            self.fs.delete(self._path(name), True)
            return False
        before = [i for i, e in enumerate(log) if e[1] == "only"]
        for number, _, folder in log[: before[-1]] if before else []:
            if folder:
                self.fs.delete(self._path(folder), True)
            self.fs.delete(self._path(f"log/{number:012d}"), False)
        return True

    def compact(self) -> bool:
        """Write the ledger whole; nothing is done if another writer is faster."""
        return self._replace(lambda rows: rows)

    def records(self, source: str | None = None) -> DataFrame:
        rows = self.read()
        return rows if source is None else rows.where(F.col("source_name") == source)

    def clear(self, source: str | None = None) -> int:
        """Forget the records of a source, or all; their number."""
        while True:
            gone = self.records(source).count()
            if self._replace(lambda rows: rows.where(F.lit(False) if source is None else ~F.col("source_name").eqNullSafe(F.lit(source)))):
                return gone

    def clone(self, path: str) -> int:
        """Copy all records over what is at ``path``, a line of JSON each with the key as the name of its record; their number. An empty ledger copies nothing."""
        rows = self.read()
        if rows.isEmpty():
            return 0
        record = F.struct(*[c for c in COLUMNS if c != "document_key"])
        rows.select(F.to_json(F.create_map(F.coalesce("document_key", F.lit("")), record)).alias("value")).write.mode("overwrite").text(path)
        return self.spark.read.text(path).count()

    def seed(self, path: str) -> None:
        """Mark the records of a clone."""
        record = ", ".join(c.replace(" ", ": ") for c in SCHEMA.split(", ")[1:])
        rows = self.spark.read.text(path).select(F.explode(F.from_json("value", f"map<string, struct<{record}>>")).alias("document_key", "r"))
        self.mark(rows.select("document_key", "r.*"))


def run_incremental(spark: SparkSession, refs: DataFrame, ledger: Ledger, checkpoint: str, process: Callable[[DataFrame], DataFrame], *, stage: str, source: str, code_version: str, force: bool = False) -> None:
    """Process the references of a stream (key, content_type, version) that the ledger doesn't hold.

    ``process`` takes pending references and returns the keys that succeeded (document_key); only these are marked.
    With ``force`` the ledger isn't asked, but still marked.
    """

    def batch(rows: DataFrame, _: int) -> None:
        known = ledger.read() if not force else spark.createDataFrame([], SCHEMA)
        pending = C.ledger_pending(rows.dropDuplicates(["key", "version"]), known, stage, source)
        done = process(pending)
        ledger.mark(done.select("document_key", F.lit(source).alias("source_name"), F.current_timestamp().alias("processed_at"), F.lit(code_version).alias("code_version"), F.lit(None).cast("string").alias("department")))

    refs.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start().awaitTermination()


def references(rows: DataFrame) -> DataFrame:
    """Documents (source, doc_id, text) as references, versioned by content."""
    return rows.select(S.output_key(F.col("source"), F.col("doc_id").cast("string")).alias("key"), F.lit("text/plain").alias("content_type"), F.md5("text").alias("version"))
