"""Sending this package to the executors, whose Python workers import it."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package, once a session."""
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tessera-")  # the driver serves the archive from here
    atexit.register(shutil.rmtree, folder, True)
    shutil.copytree(package, f"{folder}/all/tessera", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/tessera", "zip", f"{folder}/all"))
    context._tessera_shipped = True
