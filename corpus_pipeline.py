"""The training-data pipeline: five stages over ``documents``, each one an operator of ``tessera.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, language_id, mixing, near_dup, token_output
from tessera.llm.common import drop_path, scratch, ship, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is none of those learned go."""
    ship(spark)
    return language_id.keep_identified(docs, language_id.fitted(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies stays."""
    ship(spark)
    return near_dup.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target shares; a document taken twice has two rows."""
    ship(spark)
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back as one row a document: doc_id, start, n_tokens, ids_crc32."""
    ship(spark)
    return token_output.read_tokens(token_output.write_tokens(docs, scratch(spark, "tokens")))


STAGES = [
    ("language_id", identify_language),
    ("near_dup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("token_output", write_tokens),
]

#: Not expressible in SQL (a fitted language filter, order min-hash, a tokenizer); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            drop_path(spark, last)
        last = path
    out = STAGES[-1][1](spark, docs, sf_dir)  # written and closed; what is read later are its own files
    if last:
        drop_path(spark, last)
    return out
