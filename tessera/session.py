"""Sessions with the settings that the engine expects, and a preflight check."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: Set on a new session only; a session that the caller brings keeps its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def make_session(name: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def preflight(spark: SparkSession, sf_dir: str) -> list[str]:
    """What would stop a run: tables that can't be read, a Spark that is too old. Empty if nothing would."""
    from .tables import TABLES

    found = []
    if int(spark.version.split(".")[0]) < 4:
        found.append(f"Spark 4 is needed, this is {spark.version}")
    for name in TABLES:
        try:
            spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")).schema
        except Exception as error:
            found.append(f"{name}: {type(error).__name__}")
    return found
