"""Every query of the engine by name, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.dialect import DUCKDB, SPARK
from ..plans.passthrough import PASSTHROUGH
from ..plans.workload import WORKLOAD
from ..tables import run_sql, with_views

Query = Callable[[SparkSession, str], DataFrame]


def _sql_query(make) -> Query:
    return lambda spark, sf_dir: run_sql(spark, sf_dir, make(SPARK))


def all_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Name to query, and name to SQL."""
    from . import chunk_queries, corpus_queries, ordered_queries, retrieval_queries, stream_queries, time_queries

    found: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for group in (WORKLOAD, PASSTHROUGH):
        for name, make in group.items():
            found[name] = _sql_query(make)
            sql[name] = with_views(make(DUCKDB), DUCKDB)
    for module in (corpus_queries, chunk_queries, ordered_queries, retrieval_queries, stream_queries, time_queries):
        found |= module.QUERIES
        sql |= {name: with_views(text, DUCKDB) for name, text in module.SQL.items()}
    return found, sql
