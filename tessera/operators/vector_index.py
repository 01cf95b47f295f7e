"""A vector index: inverted lists by k-means with product-quantised residuals, written as a table, re-ranked exactly.

Centroids and code books are fitted on at most ``SAMPLE`` rows, those of the smallest hashes of their ids; every row is
indexed. The index is a Parquet table partitioned by list, with each row's code (a byte for each part of its residual) and, for
the re-ranking, its vector. A search reads only the lists that its queries probe: they are a filter on the partition column.
Codes alone give each row's approximate distance by looked-up sums; the best ``candidates`` of each query are
compared exactly.

How many lists to probe depends on how the vectors lie: where they form clusters, a few do; unit vectors without clusters
need most lists for nine of ten nearest (44 of 64, the default), and the codes alone spare the exact comparison then.

A list may be as hot as it likes: its rows are many file splits, and each task keeps its own best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..store import numbered, stored
from ..workers import ship
from .search import QUERY_BYTES, SCALE, best_of, pieces, units

SAMPLE = 20_000
LISTS = 64
PARTS = 16
CODES = 256
PROBES = 44
CANDIDATES = 200
AT_ONCE = 128  # queries that a task compares at once
_NONE = -(1 << 30)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """Centroids of Lloyd's algorithm; an empty one moves to the point farthest from its own."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        near, far = nearest(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        centres[~full] = x[np.argsort(-far)[: (~full).sum()]]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest centre and its squared distance."""
    d = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


class Model:
    """Centroids and a code book for each part of the residuals; its size depends on its parameters only."""

    def __init__(self, sample: np.ndarray, lists: int = LISTS, parts: int = PARTS, codes: int = CODES) -> None:
        self.centres = kmeans(sample, lists)
        residual = sample - self.centres[nearest(sample, self.centres)[0]]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(parts, sample.shape[1]))
        self.books = [kmeans(residual[:, c], codes, seed=i + 1) for i, c in enumerate(self.cuts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists, _ = nearest(x, self.centres)
        residual = x - self.centres[lists]
        return lists, np.stack([nearest(residual[:, c], b)[0] for c, b in zip(self.cuts, self.books)], 1).astype(np.uint8)

    def products(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner products of queries with the centroids, and with each code of each part."""
        return q @ self.centres.T, np.stack([np.pad(q[:, c] @ b.T, ((0, 0), (0, CODES - len(b)))) for c, b in zip(self.cuts, self.books)], 1)


def fit(vectors: DataFrame, *, sample: int = SAMPLE, lists: int = LISTS, parts: int = PARTS) -> Model:
    """A model from at most ``sample`` rows of ``vectors`` (vec_id, embedding)."""
    n = vectors.count()
    chosen = vectors if n <= sample else vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < int(sample / n * (1 << 20) * 0.95))
    rows = chosen.where("embedding IS NOT NULL").select(F.col("embedding").cast("array<double>").alias("e")).limit(sample).toPandas()["e"]
    size = rows.map(len).mode()
    return Model(units(rows[rows.map(len) == size[0]].to_numpy())[0], lists, parts)


def build(vectors: DataFrame, model: Model, path: str) -> None:
    """Write the index of all ``vectors`` (vec_id, embedding, others) to ``path``; rows without a direction or of another length have none."""
    spark = vectors.sparkSession
    ship(spark)
    size = len(model.centres[0])
    sent = spark.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame = frame[frame["embedding"].map(lambda e: e is not None and len(e) == size) & frame["vec_id"].notna()]
            if len(frame):
                unit, good = units(frame["embedding"].to_numpy())
                lists, codes = sent.value.encode(unit)
                yield pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(np.int64)[good], "code": [c.tobytes() for c in codes], "unit": list(unit), "list": lists})

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    coded = rows.mapInPandas(run, "vec_id long, code binary, unit array<double>, list int")
    # a list's rows go to as many tasks as hashes of ids spread them over, so a hot list is several files
    coded.repartition("list", F.pmod(F.xxhash64("vec_id"), F.lit(8))).write.partitionBy("list").parquet(path)


def search(spark: SparkSession, path: str, model: Model, queries: DataFrame, k: int = 10, probes: int = PROBES, candidates: int = CANDIDATES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, vec_id, score (cosine, six places), rank: the k nearest among what the ``probes`` nearest lists hold.

    A query's own row is a candidate too. Queries go in passes of at most ``query_bytes`` of vectors.
    """
    ship(spark)
    sent_model = spark.sparkContext.broadcast(model)
    size = len(model.centres[0])
    asked = queries.where(F.size("query") == size).select(F.col("query_id").cast("long").alias("query_id"), F.col("query").cast("array<double>").alias("query"))
    asked, _ = stored(numbered(asked, ["query_id"]), "queries")
    n, per_pass = asked.count(), max(1, query_bytes // (8 * size))
    out = []
    for begin in range(0, n, per_pass):
        block = asked.where((F.col("place") >= begin) & (F.col("place") < begin + per_pass)).toPandas()
        unit, good = units(block["query"].to_numpy())
        ids = block["query_id"].to_numpy(np.int64)[good]
        probed = np.argsort(-(unit @ model.centres.T), axis=1)[:, :probes]
        by_list = {int(c): np.flatnonzero((probed == c).any(1)) for c in np.unique(probed)}
        sent = spark.sparkContext.broadcast((ids, unit, by_list))
        rows = spark.read.parquet(path).where(F.col("list").isin(list(by_list)))
        found, _ = stored(rows.mapInPandas(_probe(sent, sent_model, candidates), "query_id long, vec_id long, approximate double, score double"), "probed")
        near = found.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("approximate"), "vec_id"))).where(F.col("r") <= candidates)
        out.append(stored(near.select("query_id", "vec_id", "score"), "near")[0])
        sent.destroy()
    if not out:
        return spark.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    paths = [f for df in out for f in df.inputFiles()]
    near = spark.read.schema("query_id long, vec_id long, score double").parquet(*paths)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)


def _probe(sent, sent_model, candidates: int):
    """Each query's ``candidates`` best by codes of what the task reads.

    ``AT_ONCE`` queries meet a piece at a time, and only their products with the code books are held: those of one query
    take as much as a hundred vectors.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, unit, by_list = sent.value
        model = sent_model.value
        approximate = np.full((len(ids), candidates), _NONE, np.int32)
        exact, vec_id = np.zeros((len(ids), candidates), np.int32), np.zeros((len(ids), candidates), np.int64)
        for frame in pieces(frames):
            for name, part in frame.sort_values("vec_id").groupby("list"):
                codes = np.frombuffer(b"".join(part["code"]), np.uint8).reshape(len(part), -1)
                x, new = np.stack(part["unit"].to_numpy()), part["vec_id"].to_numpy(np.int64)
                asked = by_list[int(name)]  # of this list's queries
                for mine in np.array_split(asked, -(-len(asked) // AT_ONCE)):
                    to_centre, to_codes = model.products(unit[mine])
                    near = np.repeat(to_centre[:, int(name)][:, None], len(part), 1)
                    for j in range(codes.shape[1]):
                        near += to_codes[:, j][:, codes[:, j]]
                    place, at = best_of(np.rint(near * SCALE).astype(np.int64).clip(-2 * SCALE, 2 * SCALE), np.arange(len(part)), candidates)
                    scores = np.rint(np.einsum("qd,qkd->qk", unit[mine], x[at]) * SCALE)
                    both = [np.concatenate(pair, 1) for pair in ((approximate[mine], place.astype(np.int32)), (exact[mine], scores.astype(np.int32)), (vec_id[mine], new[at]))]
                    order = np.lexsort((both[2], -both[0]), axis=1)[:, :candidates]
                    approximate[mine], exact[mine], vec_id[mine] = (np.take_along_axis(b, order, 1) for b in both)
        for begin in range(0, len(ids), AT_ONCE):
            some = slice(begin, begin + AT_ONCE)
            row, column = np.nonzero(approximate[some] > _NONE)
            take = lambda x: x[some][row, column]
            yield pd.DataFrame({"query_id": ids[some][row], "vec_id": take(vec_id), "approximate": take(approximate) / SCALE, "score": take(exact) / SCALE})

    return run
