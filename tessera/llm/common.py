"""Shared pieces of the training-data operators: tables, the shared folder, folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import drop_path, numbered, scratch, shared_root, stored
from ..workers import ship as ship_package

__all__ = ["crc32_of_id", "drop_path", "numbered", "scratch", "shared_root", "ship", "shuffle_width", "stored", "table"]


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package; rows here are whole texts, so Arrow batches are smaller than Spark's default of 10,000 rows, unless the session says otherwise."""
    ship_package(spark)
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read by Spark alone so that any store works."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id written as text, the fold key of the held-out rows."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
