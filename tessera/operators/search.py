"""Exact vector search of many queries: blocks of queries and rows are multiplied as matrices.

Queries go in passes. A pass holds at most ``QUERY_BYTES`` of unit vectors, which are broadcast; a task multiplies
them with one Arrow batch after the other and keeps the k best of each query and corpus, so what shuffles is k rows a query,
corpus and task. Passes append to one table, which is ranked once at the end: the plan doesn't grow with the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import numbered, scratch, stored
from ..workers import ship

QUERY_BYTES = 2 << 20
ROWS = 1024  # that meet the queries at once
HELD_CORPORA = 64
SCALE = 1_000_000  # scores have six places, and are compared as whole numbers


def units(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Those of equally long vectors that have a finite length above 0, as unit vectors, and which they are."""
    x = np.array([np.asarray(v, float) for v in vectors]) if len(vectors) else np.zeros((0, 0))
    norms = np.sqrt((x * x).sum(1)) if x.size else np.zeros(len(x))
    good = np.isfinite(norms) & (norms > 0)
    return x[good] / norms[good, None], np.flatnonzero(good)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of ``scores`` (whole numbers) the k largest, with their ids; of equal ones those of smaller ids."""
    order = np.argsort(ids, kind="stable")
    scores, ids = scores[:, order], ids[order]
    if scores.shape[1] > k:
        key = (2 * SCALE - scores) * scores.shape[1] + np.arange(scores.shape[1])  # unique, by score and then id
        top = np.argpartition(key, k - 1, axis=1)[:, :k]
        return np.take_along_axis(scores, top, 1), ids[top]
    return scores, np.broadcast_to(ids, scores.shape)


def merged(one: tuple | None, two: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two results."""
    if one is None:
        return two
    scores, ids = (np.concatenate(x, 1) for x in zip(one, two))
    order = np.lexsort((ids, -scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _rows(query_ids: np.ndarray, corpus, found: tuple) -> pd.DataFrame:
    scores, ids = found
    return pd.DataFrame({"query_id": np.repeat(query_ids, scores.shape[1]), "corpus": [corpus] * scores.size, "vec_id": ids.ravel(), "score": scores.ravel() / SCALE})


def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of the frames of at most ``ROWS`` rows."""
    return (frame.iloc[at : at + ROWS] for frame in frames for at in range(0, len(frame), ROWS))


def scan(asked, k: int):
    """A map over frames of vec_id, corpus, embedding: the k best of each query (of ``asked``: length to ids and unit vectors) and corpus."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def emit():
            for (size, corpus), found in held.items():
                yield _rows(asked.value[size][0], None if corpus is _NULL else corpus, found)
            held.clear()

        for frame in pieces(frames):
            frame = frame[frame["embedding"].notna() & frame["vec_id"].notna()]
            sizes = frame["embedding"].map(len)
            for size in set(sizes) & set(asked.value):
                part = frame[sizes == size]
                x, good = units(part["embedding"].to_numpy())
                ids, corpora = part["vec_id"].to_numpy(np.int64)[good], part["corpus"].to_numpy()[good]
                scores = np.rint(asked.value[size][1] @ x.T * SCALE).astype(np.int64)
                codes, names = pd.factorize(corpora, use_na_sentinel=False)
                for i, name in enumerate(names):
                    mine, key = codes == i, (size, _NULL if pd.isna(name) else name)
                    held[key] = merged(held.get(key), best_of(scores[:, mine], ids[mine], k), k)
            if len(held) > HELD_CORPORA:
                yield from emit()
        yield from emit()

    return run


_NULL = "\0null"


def search_all(vectors: DataFrame, queries: DataFrame, k: int = 10, corpus: str = "label", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """For each query (query_id, query) and each corpus of ``vectors`` (vec_id, embedding), its k nearest by cosine: query_id, corpus, vec_id, score, rank.

    Vectors and queries that are null, have no length, components that aren't finite, or another number of components than
    the other side take no part. A null corpus is a corpus. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    ship(spark)
    kind = vectors.schema[corpus].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(corpus).alias("corpus"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = queries.where("query IS NOT NULL AND size(query) > 0").select(F.col("query_id").cast("long").alias("query_id"), F.col("query").cast("array<double>").alias("query"))
    asked, _ = stored(numbered(asked, ["query_id"]), "queries")
    shape = asked.agg(F.count("*").alias("n"), F.max(F.size("query")).alias("size")).first()
    per_pass = max(1, query_bytes // (8 * (shape["size"] or 1)))
    schema = f"query_id long, corpus {kind}, vec_id long, score double"
    folder = scratch(spark, "nearest")
    spark.createDataFrame([], schema).write.parquet(folder)
    for begin in range(0, shape["n"], per_pass):
        block = asked.where((F.col("place") >= begin) & (F.col("place") < begin + per_pass)).toPandas()  # at most query_bytes
        matrices = {}
        for size, part in block.groupby(block["query"].map(len)):
            unit, good = units(part["query"].to_numpy())
            matrices[size] = (part["query_id"].to_numpy(np.int64)[good], unit)
        sent = spark.sparkContext.broadcast(matrices)
        rows.mapInPandas(scan(sent, k), schema).write.mode("append").parquet(folder)
        sent.destroy()
    found = spark.read.schema(schema).parquet(folder)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "corpus").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return ranked.withColumnRenamed("corpus", corpus)
