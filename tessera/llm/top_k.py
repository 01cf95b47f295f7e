"""Exact top-k search by distributed histogram selection.

Scores are integer inner products of vectors quantised to ``floor(256 * x)``. For each query the k-th best score is
located without sorting: every row is scored, each task counts its scores in ``BINS`` bins a query, the counts are
added up over all tasks, and the bin that holds the k-th value is cut into bins again, until a bin is one score
wide. A last pass keeps what reaches the k-th score; of rows that tie with it each task passes on only its k
smallest ids a query, so a third of all vectors being equal costs no more. Ranks go by score, then id.

Queries are a stated set against all rows and go in blocks of at most ``BLOCK`` queries: a block (a few MB at most,
whatever the table's size) is broadcast, each pass is one map over the vectors in batches, and the block's
histograms (``BLOCK * BINS`` counts) meet on the driver. Vectors are quantised and written once, so passes read
whole numbers. Products run in float64, exact below 2**53 and checked; beyond that in Python integers.

Edge cases: vectors that are null, or hold a null or a component that isn't finite take no part, as query or
candidate; all others do. A score of ``2**61`` or more in size, for which a long has no room in the histograms, is an
error that names its row. A query meets vectors of its own length only (empty ones meet empty ones). Every row but those
with the query's own id is a candidate, those with a null id too, which come after all ids among equal scores (the id
2**63 - 1 can't be told from null); rows with a null id don't ask. Rows that repeat an id each are candidates, and of
query rows that repeat an id and differ the smallest vector asks. A query with fewer than k candidates returns them
all. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, stored, table

K = 5
BLOCK = 4096
BINS = 64
_EXACT = 1 << 53
_MOST = 1 << 61
_NO_ID = (1 << 63) - 1
_RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id and the components as floor(256 * x), whole numbers in double precision; rows that take no part are left out."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    usable = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # from 2**53 on a double is whole
    floor = lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)
    return wide.where(F.col("e").isNotNull() & usable).select("vec_id", F.transform("e", lambda x: floor(x * 256)).alias("v"))


def _by_length(ids: np.ndarray, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors of equal length as one matrix of integers."""
    lengths = np.diff(np.asarray(vectors.offsets))
    flat, begins = np.asarray(vectors.values), np.asarray(vectors.offsets)[:-1]
    return {int(n): (ids[lengths == n], flat[begins[lengths == n][:, None] + np.arange(n)]) for n in np.unique(lengths)}


def _products(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    if float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) if np.isfinite(x) else _MOST**2 for x in row] for row in m.tolist()], object).reshape(m.shape)
    exact = whole(queries) @ whole(rows).T
    exact[own] = 0
    beyond = (np.abs(exact) >= _MOST).any(axis=0)
    if beyond.any():
        raise ValueError(f"a score with vec_id {ids[beyond][0]} is 2**61 or more in size")
    return exact.astype(np.int64)


_SLICE = 1024


def _scores(block, batches):
    """For each slice of rows and each length: query numbers, row ids, scores, and which pairs are no candidates."""
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE):
            batch = whole.slice(at, _SLICE)
            for n, (ids, rows) in _by_length(np.asarray(batch.column(0).fill_null(_NO_ID)), batch.column(1)).items():
                if n in block:
                    numbers, query_ids, queries = block[n]
                    own = query_ids[:, None] == ids[None, :]
                    yield numbers, query_ids, ids, _products(queries, rows, ids, own), own


def _histogram(shared):
    def count(batches):
        block, low, width, total = shared.value
        counts = np.zeros((total, BINS + 1), np.int64)  # the last bin: above the window
        for numbers, _, _, scores, own in _scores(block, batches):
            lowest, wide = low[numbers][:, None], width[numbers][:, None]
            bins = np.clip((scores - lowest) // wide, -1, BINS)
            bins[own] = -1
            flat = (np.arange(len(numbers))[:, None] * (BINS + 2) + bins + 1).ravel()
            counts[numbers] += np.bincount(flat, minlength=len(numbers) * (BINS + 2)).reshape(-1, BINS + 2)[:, 1:]
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])

    return count


def _adder(batches):
    counts = None
    for batch in batches:
        for part in batch.column(0).to_pylist():
            part = np.frombuffer(part, np.int64)
            counts = part.copy() if counts is None else counts + part
    if counts is not None:
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["counts"])


def _selector(shared):
    def select(batches):
        block, kth, k = shared.value
        best: dict[int, list[tuple[int, int]]] = {}
        for numbers, query_ids, ids, scores, own in _scores(block, batches):
            reached = (scores >= kth[numbers][:, None]) & ~own
            for q, r in zip(*np.nonzero(reached)):
                best.setdefault(int(query_ids[q]), []).append((-int(scores[q, r]), int(ids[r])))
            for found in best.values():
                if len(found) > 8 * k:
                    found.sort()
                    del found[k:]
        rows = [(q, v, -s) for q, found in best.items() for s, v in sorted(found)[:k]]
        rows = [(q, None if v == _NO_ID else v, s) for q, v, s in rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

    return select


def _block(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    out = {}
    for n in {len(r["v"]) for r in rows}:
        numbers = np.array([i for i, r in enumerate(rows) if len(r["v"]) == n])
        out[n] = (numbers, np.array([rows[i]["vec_id"] for i in numbers], np.int64), np.array([rows[i]["v"] for i in numbers], np.float64).reshape(len(numbers), n))
    return out


def _summed(parts: DataFrame, partitions: int) -> np.ndarray:
    """The sum of the tasks' histograms, halved by executors until a few reach the driver."""
    while partitions > 16:
        partitions = -(-partitions // 16)
        parts = parts.repartition(partitions).mapInArrow(_adder, "counts binary")
    return sum(np.frombuffer(row["counts"], np.int64) for row in parts.select("counts").collect())


def search(vectors: DataFrame, is_query: Column, *, k: int = K, block: int = BLOCK) -> DataFrame:
    """For each query row (``is_query`` of vec_id): query_id, rank, vec_id, score of its k best other rows."""
    spark = vectors.sparkSession
    rows, _ = stored(quantised(vectors), "quantised")
    queries, _ = stored(rows.where(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id"), "queries")
    partitions = rows.rdd.getNumPartitions()
    largest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    out = scratch(spark, "top")
    held: list = []

    def run(held: list, number: int) -> None:
        packed = _block(held)
        # no score is beyond the product of the two lengths; the window starts there
        norms = np.array([float(np.sqrt(sum(float(x) * x for x in r["v"]))) for r in held]) * np.sqrt(largest or 0.0) + 1
        bound = np.minimum(np.ceil(norms), float(_MOST)).astype(np.int64)
        low, width = -bound, np.maximum(1, -(-2 * bound // BINS) + 1)
        kth, above, done = np.full(len(held), -(1 << 62), np.int64), np.zeros(len(held), np.int64), np.zeros(len(held), bool)
        while not done.all():
            shared = spark.sparkContext.broadcast((packed, low, width, len(held)))
            counts = _summed(rows.mapInArrow(_histogram(shared), "counts binary"), partitions).reshape(len(held), BINS + 1)
            shared.unpersist()
            from_top = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
            for i in np.flatnonzero(~done):
                enough = np.flatnonzero(from_top[i, :BINS] >= k)
                if not len(enough):  # fewer than k candidates: all of them
                    done[i] = True
                    continue
                bin_ = int(enough[-1])
                if width[i] == 1:
                    kth[i], done[i] = low[i] + bin_, True
                else:
                    low[i] += bin_ * width[i]
                    width[i] = -(-width[i] // BINS)
        shared = spark.sparkContext.broadcast((packed, kth, k))
        rows.mapInArrow(_selector(shared), _RESULT).write.parquet(f"{out}/block={number}")

    number = 0
    for row in queries.orderBy("vec_id").toLocalIterator():
        held.append(row)
        if len(held) == block:
            run(held, number)
            held, number = [], number + 1
    if held or not number:
        run(held, number)
    ranked = spark.read.schema(_RESULT).parquet(out).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0)


OP5_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""
