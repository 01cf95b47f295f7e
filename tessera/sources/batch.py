"""Batch embedding files: requests out, results back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT = "recordId string, modelOutput struct<embedding: array<float>>, error string"


def request_lines(requests: DataFrame) -> DataFrame:
    """Requests (record_id, text) as JSON lines."""
    return requests.select(F.to_json(F.struct(F.col("record_id").alias("recordId"), F.struct(F.col("text").alias("inputText")).alias("modelInput"))).alias("value"))


def result_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the result files, manifests left out."""
    return spark.read.option("pathGlobFilter", "*.jsonl.out").option("recursiveFileLookup", True).text(folder)


def read_results(lines: DataFrame, requests: DataFrame) -> DataFrame:
    """Results of known requests: token, embedding or error. Blank lines and unknown ids are skipped."""
    parsed = lines.where(F.trim("value") != "").select(F.from_json("value", RESULT).alias("r")).where("r.recordId IS NOT NULL")
    rows = parsed.select(F.col("r.recordId").alias("record_id"), F.col("r.modelOutput.embedding").alias("embedding"), F.col("r.error").alias("error"))
    return rows.join(requests.select("record_id", "token"), "record_id").select("token", F.when(F.col("error").isNull(), F.col("embedding")).alias("embedding"), "error")
