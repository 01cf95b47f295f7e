"""Intermediate tables in the folder that driver and executors share: cut lineage that survives lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session on one machine (tests) may lack that setting; it gets a temporary folder. Elsewhere that is an error.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tessera-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/tessera/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def numbered(rows: DataFrame, order: list[Column | str], place: str = "place") -> DataFrame:
    """``rows`` with their place (from 0) in an order, without a task that sees all of them.

    Rows are dealt by ranges of the order and written once with their partition and running id, so that counts and
    places come from the same deal; the partitions' counts, a row each, are summed before.
    """
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, *order).sortWithinPartitions(*order)
    dealt, _ = stored(dealt.withColumns({"__p": F.spark_partition_id(), "__m": F.monotonically_increasing_id()}), "dealt")
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__m").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = dealt.join(counts.withColumn("__before", before).select("__p", "__first", "__before"), "__p")
    return joined.withColumn(place, F.col("__before") + F.col("__m") - F.col("__first")).drop("__p", "__m", "__n", "__first", "__before")
