"""File sources and sinks: listings, exports, stage outputs, keyed JSON."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import stored

OUTPUT = "key string, source_name string, content_type string, version string, text string, chars long, metadata map<string,string>, extracted_at string, code_version string"
_CSV = {"header": True, "inferSchema": False, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": -1}


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path, modified and length of the files below a folder; contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), "length")


def load_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """path and content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "content")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text; a byte-order mark stays in the first header."""
    return spark.read.options(**_CSV).csv(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_csv``, without a byte-order mark in the first header."""
    rows = read_csv(spark, path)
    return rows.toDF(*[c.lstrip("﻿") for c in rows.columns])


def with_columns_if_missing(rows: DataFrame, names: list[str]) -> DataFrame:
    """The rows with NULL text columns for the names that they lack: both layouts of an export then read alike."""
    return rows.withColumns({n: F.lit(None).cast("string") for n in names if n not in rows.columns})


def export_key(spark: SparkSession, export: str, prefix: str, old_prefix: str) -> str:
    """The path of an export: ``latest`` is the newest CSV under ``prefix``, a bare name is under ``old_prefix``, else itself."""
    if export == "latest":
        files = list_files(spark, prefix).where(F.lower("path").endswith(".csv"))
        found = files.agg(F.max_by("path", F.struct("modified", "path"))).first()[0]
        if found is None:
            raise FileNotFoundError(f"no export under {prefix}")
        return found
    return export if "/" in export else f"{old_prefix.rstrip('/')}/{export}"


def read_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Stage outputs, one JSON document a file; a folder that doesn't exist has none."""
    try:
        return spark.read.schema(OUTPUT).option("recursiveFileLookup", True).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], OUTPUT)


def write_outputs(rows: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """JSON lines by source: the way that scales; ``write_keyed`` makes one file a key where others expect that."""
    rows.write.mode(mode).partitionBy("source_name").json(folder)


def _keyed(folder: str, indent: int | None):
    def write(batches):
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for key, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{root}/{key}"
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(path) as out:
                    out.write(json.dumps(json.loads(payload), ensure_ascii=False, indent=indent).encode())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["key"])

    return write


def write_keyed(rows: DataFrame, folder: str, indent: int | None = 2) -> int:
    """One JSON file for each (key, payload), written by the executors to a folder that all share; the number written.

    A key that is written again, or by a repeated task, is overwritten with the same content.
    """
    from ..workers import ship

    ship(rows.sparkSession)
    return rows.select("key", "payload").mapInArrow(_keyed(folder, indent), "key string").count()


class MemoryWriter:
    """Keeps (key, payload) rows under a temporary view, without files for others; the last write of a key wins.

    Within one write the greatest payload of a key counts, so that reruns agree. Null keys are a key.
    """

    def __init__(self, spark: SparkSession, view: str) -> None:
        self.spark, self.view = spark, view
        self.rows, self.writes = empty(spark, "key string, payload string, number int"), 0
        self._show()

    def _show(self) -> None:
        last = self.rows.groupBy("key").agg(F.max_by("payload", F.struct("number", "payload")).alias("payload"))
        last.createOrReplaceTempView(self.view)

    def write(self, rows: DataFrame) -> None:
        self.writes += 1
        kept, _ = stored(rows.select(F.col("key").cast("string"), F.col("payload").cast("string"), F.lit(self.writes).alias("number")), "memory")
        self.rows = self.rows.union(kept)
        self._show()


def payload(rows: DataFrame, key: str = "key") -> DataFrame:
    """Rows as (key, payload) with the row as JSON; NULLs are left out."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*rows.columns)).alias("payload"))


def empty(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
