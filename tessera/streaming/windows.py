"""Event windows, an extension: tumbling counts and sessions, the same for a batch and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_stream(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Events with a watermark; times without a zone become times with one, which watermarks need."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "user_id", "n")
