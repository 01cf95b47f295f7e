"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Each whole text becomes about twenty statistics in one map; they are written once (a few numbers a document) and
everything else reads them. The Gaussian kernel over the standardised statistics is approximated by ``FEATURES``
random cosines; executors sum the normal equations of their partition, the driver adds the few sums and solves the
ridge system. A fifth of the teaching rows isn't fitted but calibrates: their ridge scores, counted in bins, give a
non-decreasing step function by pool-adjacent-violators, read with linear interpolation.

At most about ``MAX_LABELLED`` labelled rows are used, chosen by a hash of the id over the whole table (the
documented bound of the sample); so at most a handful of partial sums reach the driver.

Edge cases: a null text counts as empty, and empty texts get a score like any other. Rows without a label don't
teach. Without any teaching row every score is 0.5; with one class only, every score is that class. Repeated labels
all teach. Null ids don't teach. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_of_id, stored, table

FEATURES = 256
RIDGE = 1e-3
#: The kernel's width in standard deviations a statistic, and where statistics end: an outlier stays near the others of its kind.
WIDTH, CLIP = 1.5, 5
MAX_LABELLED = 200_000
BINS = 400
THRESHOLD = 0.3
_SYMBOL = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_PUNCTUATION = b".,;:!?'\"()-"
_UPPER = re.compile(rb"[A-Z]")
STATISTICS = 20


def _share(raw: bytes, chars: bytes) -> float:
    return 1 - len(raw.translate(None, chars)) / len(raw) if raw else 0.0


def statistics_of(text: str | None) -> list[float]:
    """The statistics of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x.strip() for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    n_words, n_lines = len(words), len(lines)
    if not n_words:
        return [0.0] * STATISTICS
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    pairs = n_words - 1
    repeated_pairs = sum(a == b for a, b in zip(words, words[1:])) / pairs if pairs else 0.0
    distinct_lines = len(set(lines))
    upper, digit = _share(raw, bytes(range(65, 91))), _share(raw, b"0123456789")
    lower = _share(raw, bytes(range(97, 123)))
    common = counts.most_common(3)
    capital = sum(w[:1].isupper() for w in words) / n_words
    whole = sum(w.isupper() for w in words) / n_words
    return [
        np.log1p(len(raw)), np.log1p(n_words), np.log1p(n_lines), float(lengths.mean()), float(lengths.std()), np.log1p(n_words / max(1, n_lines)),
        upper, lower, digit, _share(raw, _PUNCTUATION), _share(raw, bytes(set(_SYMBOL) - set(_PUNCTUATION))), _share(raw, b"|"), _share(raw, b"!"),
        len(counts) / n_words, common[0][1] / n_words, sum(c for _, c in common) / n_words, repeated_pairs, 1 - distinct_lines / max(1, n_lines), capital, whole,
    ]


def _slices(batches, rows: int):
    """Smaller batches, which bound what a worker holds."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            yield whole.slice(at, rows)


def _statistician(batches):
    for batch in _slices(batches, 256):
        rows = [statistics_of(text) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id and its statistics ``x``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_statistician, "doc_id long, x array<double>")


class QualityModel:
    """Standardisation, random features, ridge weights and the calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.directions = random.normal(size=(len(mean), features)) / (WIDTH * np.sqrt(len(mean)))
        self.phases = random.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, STATISTICS)


def _sums(shared):
    """Adds the normal equations of a partition; one row comes out."""

    def add(batches):
        model, n = shared.value, FEATURES + 1
        gram, target = np.zeros((n, n)), np.zeros(n)
        for batch in _slices(batches, 2048):
            z = model.expand(_matrix(batch.column(0)))
            gram += z.T @ z
            target += z.T @ np.asarray(batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary()), pa.array([target.tobytes()], pa.binary())], names=["gram", "target"])

    return add


def _raw_scores(shared):
    def score(batches):
        for batch in _slices(batches, 2048):
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.raw(_matrix(batch.column(0)))), batch.column(1)], names=["raw", "y"])

    return score


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to ``y`` (in order of ``x``) by pooling adjacent violators."""
    pools: list[list[float]] = []
    for value, w in zip(y, weight):
        pools.append([value, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            total = a[1] + b[1]
            pools.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in pools]) if pools else np.zeros(0)


def fit(rows: DataFrame, *, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """A model from (doc_id, x, y) with y 0 or 1; about ``max_labelled`` rows at most, chosen by hash."""
    spark = rows.sparkSession
    rows = rows.where(F.col("y").isNotNull() & F.col("x").isNotNull())
    total = rows.count()
    draw = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < max_labelled / max(1, total)).withColumn("calibrates", F.pmod(F.xxhash64(F.lit(17), "doc_id"), F.lit(5)) == 0)
    # stored once, so that what makes the rows keeps its own partitions and runs no more for each pass
    sample = stored(sample.select("x", "y", "calibrates"), "labelled")[0].coalesce(8)
    parts = [F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(STATISTICS)] + [F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(STATISTICS)]
    row = sample.agg(*parts, F.min("y").alias("low"), F.max("y").alias("high")).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(STATISTICS)])
    scale = np.array([row[f"s{i}"] or 0.0 for i in range(STATISTICS)])
    model = QualityModel(mean, np.where(scale > 1e-12, scale, 1.0))
    if row["low"] is None or row["low"] == row["high"]:
        model.steps = (np.array([0.0]), np.array([0.5 if row["low"] is None else float(row["low"])]))
        return model
    shared = spark.sparkContext.broadcast(model)
    gram, target = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
    for part in sample.where("NOT calibrates").select("x", F.col("y").cast("double")).mapInArrow(_sums(shared), "gram binary, target binary").collect():
        gram += np.frombuffer(part["gram"]).reshape(gram.shape)
        target += np.frombuffer(part["target"])
    count = max(1.0, gram[-1, -1])
    model.weights = np.linalg.solve(gram + RIDGE * count * np.eye(FEATURES + 1) / FEATURES, target)
    shared = spark.sparkContext.broadcast(model)
    scored = sample.where("calibrates").select("x", F.col("y").cast("double").alias("y")).mapInArrow(_raw_scores(shared), "raw double, y double")
    bins = scored.groupBy(F.floor(F.least(F.greatest(F.col("raw"), F.lit(-1.0)), F.lit(2.0)) * BINS).alias("b")).agg(F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("b").collect()
    if bins:
        x, y, n = (np.array([b[k] for b in bins], float) for k in ("raw", "y", "n"))
        model.steps = (x, isotonic(x, y, n))
    return model


def _scorer(shared):
    def score(batches):
        for batch in _slices(batches, 2048):
            found = shared.value.score(_matrix(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return score


def score(x: DataFrame, model: QualityModel, held_out=None) -> DataFrame:
    """Per row of statistics: doc_id, held_out, score, predicted."""
    shared = x.sparkSession.sparkContext.broadcast(model)
    return x.select("doc_id", (F.lit(False) if held_out is None else held_out).alias("held_out"), "x").mapInArrow(_scorer(shared), "doc_id long, held_out boolean, score double, predicted int")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, _ = stored(statistics(table(spark, sf_dir, "documents")), "statistics")
    part = F.pmod(crc32_of_id(), F.lit(5))
    labels = table(spark, sf_dir, "labels").where(part != 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("y"))
    return score(x, fit(x.join(labels, "doc_id")), F.coalesce(part == 0, F.lit(False)))
