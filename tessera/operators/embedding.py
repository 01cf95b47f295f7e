"""Embedding runs: job states, an offline embedder, and the way from sentences over windows and vectors to chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import chunks as K

#: The states in which a job has ended, those of them in which its results count, and the least batch.
TERMINAL = ("Completed", "Failed", "Stopped", "PartiallyCompleted", "Expired")
SUCCESS = ("Completed", "PartiallyCompleted")
MIN_BATCH = 100
MAX_RECORDS = 50_000
DIMENSIONS = 16
DOCUMENTS_AT_ONCE = 64


def job_states(events: DataFrame) -> DataFrame:
    """The last state of each job (job, ord, status), whether it has ended, and whether its results count."""
    last = events.groupBy("job").agg(F.max_by("status", "ord").alias("status"))
    return last.select("job", "status", F.col("status").isin(*TERMINAL).alias("ended"), F.col("status").isin(*SUCCESS).alias("succeeded"))


class HashEmbedder:
    """An embedder without a model: numbers from a hash of the text, equal for equal texts. Made once for each task."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[list[float] | None]:
        return [self.vector(t) for t in texts]

    def vector(self, text: str) -> list[float]:
        raw = b"".join(hashlib.sha256(f"{i}:{text}".encode()).digest() for i in range(-(-self.dimensions // 8)))
        return (np.frombuffer(raw, "<u4")[: self.dimensions] / 2.0**31 - 1).tolist()


def vectors_of(requests: DataFrame, make: Callable[[], Callable] = HashEmbedder) -> DataFrame:
    """For requests (token, text): token, embedding, error. ``make`` is called once a task; a text that fails has an error."""
    from ..workers import ship

    ship(requests.sparkSession)

    def embed(batches):
        embedder = make()
        for batch in batches:
            vectors, errors = [], []
            for text in batch.column(1).to_pylist():
                try:
                    vectors.append(embedder([text])[0])
                    errors.append(None)
                except Exception as error:
                    vectors.append(None)
                    errors.append(f"{type(error).__name__}: {error}"[:300])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.list_(pa.float64())), pa.array(errors, pa.string())], names=["token", "embedding", "error"])

    return requests.select("token", "text").mapInArrow(embed, "token string, embedding array<double>, error string")


def batch_run(requests: DataFrame, make: Callable[[], Callable] = HashEmbedder, *, max_records: int = MAX_RECORDS, min_records: int = MIN_BATCH) -> DataFrame:
    """Requests (place from 0, token, text) with their job, embedding and error; every request has one of the last two.

    Fewer requests than ``min_records``, or jobs too small to be evened out, are errors, as a batch service has them.
    """
    if max_records < 2 * min_records:
        raise ValueError(f"max_records must be at least {2 * min_records}")
    if (n := requests.count()) < min_records:
        raise ValueError(f"{n} requests are fewer than {min_records}")
    results = vectors_of(requests, make).withColumn("ord", F.lit(0))
    attached = K.reattach(requests.select("place", "token"), results)
    return K.job_numbers(requests.select("place"), "place", max_records, min_records).join(attached, "place")


def _window_vectors(docs: DataFrame, sentences: str, buffer: int, make: Callable[[], Callable]) -> DataFrame:
    """``docs`` with ``vectors``, one for each sentence with ``buffer`` sentences on either side, and ``error``, the first there was."""
    from ..workers import ship

    ship(docs.sparkSession)
    at = docs.columns.index(sentences)

    def embed(batches):
        embedder = make()
        for whole in batches:
            for begin in range(0, whole.num_rows, DOCUMENTS_AT_ONCE):
                batch = whole.slice(begin, DOCUMENTS_AT_ONCE)
                vectors, errors = [], []
                for s in batch.column(at).to_pylist():
                    vectors.append([])
                    errors.append(None)
                    try:
                        for i in range(len(s or ())):
                            vectors[-1].append(embedder([" ".join(s[max(0, i - buffer) : i + buffer + 1])])[0])
                            if vectors[-1][-1] is None:
                                raise ValueError("no vector")
                    except Exception as error:
                        errors[-1] = f"{type(error).__name__}: {error}"[:300]
                made = [pa.array(vectors, pa.list_(pa.list_(pa.float64()))), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "vectors", "error"])

    return docs.mapInArrow(embed, StructType([*docs.schema.fields, *StructType.fromDDL("vectors array<array<double>>, error string").fields]))


def semantic_nodes(docs: DataFrame, make: Callable[[], Callable] = HashEmbedder, *, buffer: int = K.BUFFER, percentile: float = K.PERCENTILE) -> DataFrame:
    """Chunks of documents (doc_id, text, metadata, source_id): sentences, windows, vectors, distances, cuts.

    A window without a vector stops the run. A document without sentences is one empty chunk. A chunk has the metadata
    of its document, and its source: the document's, or the document itself if it has none. All that a document's cuts
    depend on is in its row, so nothing shuffles: vectors, distances and cuts stay in the row, and chunks are exploded from it.
    """
    rows = docs.select("doc_id", "metadata", F.coalesce("source_id", F.col("doc_id").cast("string")).alias("source_id"), K.sentences(F.col("text")).alias("parts"))
    rows = _window_vectors(rows, "parts", buffer, make)
    rows = rows.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("failed: "), F.col("error"))).cast("string"))).where("error IS NULL")
    out = rows.select("doc_id", F.posexplode(K.parts_between("parts", K.cuts_of("vectors", percentile))).alias("chunk", "x"), "metadata", "source_id")
    return out.select("doc_id", F.col("chunk").cast("long").alias("chunk"), "x.text", F.col("x.n").cast("long").alias("sentences"), "metadata", "source_id")
