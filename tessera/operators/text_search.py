"""Ranked text search: a positional inverted index with BM25 and block maxima.

The index is a table with a row for each term and block of documents: the documents that hold the term, with its count, its
places and the document's length, how many they are and the largest weight that the term has in the block. Blocks are runs of documents as
they are dealt, at most ``BLOCK_DOCS``, so a common term is many rows, no one of them large. A task makes and sorts the rows of ``TASK_DOCS`` documents
or so, and writes a file of them: documents move once, their words don't. The table is sorted by term within its files; up to ``FILTER_TERMS`` terms of a search reach the scan as a filter.

A search takes each query's bounds first: a block can't hold a better document than the sum of its terms' largest weights. The
most promising block is scored, and its k-th score is one that the result will reach; blocks whose bound is below it
are dropped before their lists are opened. What is left is scored exactly, so the result is that of scoring everything.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import drop_path, stored
from ..workers import ship

K1, B = 1.2, 0.75
TERM = "[a-z0-9]+"
BLOCK_DOCS = 512
TASK_DOCS = 8 * BLOCK_DOCS
FILTER_TERMS = 1000


def words(text: Column) -> Column:
    """The words of a text in lower case, in order; none of a null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def plain_text(html: Column) -> Column:
    """A page without its tags."""
    return F.regexp_replace(html, "<[^>]*>", " ")


def build(docs: DataFrame, path: str) -> None:
    """Write the index of ``docs`` (id, text): ``path``/postings and ``path``/totals. Documents without words count in the totals."""
    spark = docs.sparkSession
    ship(spark)
    found = words(F.col("text"))
    # read twice, so that words are looked for once
    lengths, held = stored(docs.select("id", F.array_join(found, " ").alias("words"), F.size(found).alias("length")), "words")
    totals = lengths.agg(F.count("*").alias("n"), F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean"))
    totals.write.parquet(f"{path}/totals")
    total = spark.read.parquet(f"{path}/totals").first()
    entry = f"struct<id: {docs.schema['id'].dataType.simpleString()}, weight: double, length: int, places: array<int>>"
    dealt = lengths.where("length > 0").repartition(max(1, -(-total["n"] // TASK_DOCS)), "id")
    lists = dealt.mapInArrow(_lister(BLOCK_DOCS, total["mean"] or 1.0), f"term string, block long, n int, largest double, entries array<{entry}>")
    lists.sortWithinPartitions("term").write.parquet(f"{path}/postings")
    drop_path(spark, held)


def _runs(batches, rows: int):
    """The rows of batches in tables of ``rows``; the last has what is left."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - sum(b.num_rows for b in held))
            held.append(part)
            batch = batch.slice(part.num_rows)
            if sum(b.num_rows for b in held) == rows:
                yield pa.concat_batches(held)
                held = []
    if held:
        yield pa.concat_batches(held)


def _lister(block_docs: int, mean: float):
    """Rows of the index from documents (id, their words between blanks, how many), a block at a time."""

    def make(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        for block, docs in enumerate(_runs(batches, block_docs), first):
            n, lengths = docs.num_rows, docs.column(2).to_numpy()
            terms = pc.split_pattern(docs.column(1), " ").flatten().dictionary_encode()
            doc = np.repeat(np.arange(n), lengths)
            place = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            key = terms.indices.to_numpy().astype(np.int64) * n + doc
            order = np.argsort(key, kind="stable")  # places stay in order
            key = key[order]
            postings = np.flatnonzero(np.diff(key, prepend=-1))  # where each document of a term begins
            code, of = key[postings] // n, key[postings] % n
            rows = np.flatnonzero(np.diff(code, prepend=-1))  # where each term begins
            count = np.diff(postings, append=len(key))
            weight = _weight(count, lengths[of], mean)
            places = pa.ListArray.from_arrays(pa.array([*postings, len(key)], pa.int32()), pa.array(place[order], pa.int32()))
            entries = pa.StructArray.from_arrays([docs.column(0).take(pa.array(of)), pa.array(weight), pa.array(lengths[of], pa.int32()), places], ["id", "weight", "length", "places"])
            columns = {
                "term": terms.dictionary.take(pa.array(code[rows])),
                "block": pa.array(np.full(len(rows), block), pa.int64()),
                "n": pa.array(np.diff(rows, append=len(code)), pa.int32()),
                "largest": pa.array(np.maximum.reduceat(weight, rows)),
                "entries": pa.ListArray.from_arrays(pa.array([*rows, len(code)], pa.int32()), entries),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return make


def _weight(count, length, mean: float):
    return count * (K1 + 1) / (count + K1 * (1 - B + B * length / mean))


def search(index: str, queries: DataFrame, k: int = 10, keep: DataFrame | None = None) -> DataFrame:
    """query_id, id, score (six places), rank: the k best of each query (query_id, query); ``keep`` has the ids that may be found.

    A document must hold one word of a query at least. Words that repeat in a query count once. Equal scores go to smaller ids.
    """
    spark = queries.sparkSession
    n = spark.read.parquet(f"{index}/totals").first()["n"]
    # written, so that Spark knows their size, and no list moves to meet a few terms
    asked, _ = stored(queries.select("query_id", F.explode(F.array_distinct(words(F.col("query")))).alias("term")), "asked")
    postings = spark.read.parquet(f"{index}/postings")
    terms = [r["term"] for r in asked.select("term").distinct().limit(FILTER_TERMS + 1).collect()]
    if len(terms) <= FILTER_TERMS:
        postings = postings.where(F.col("term").isin(terms))
    found = postings.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("found"))
    rare = F.log(1 + (n - F.col("found") + 0.5) / (F.col("found") + 0.5))
    rated, _ = stored(asked.join(found, "term").select("query_id", "term", rare.alias("rare")), "rated")
    opened, _ = stored(postings.join(rated, "term").select("query_id", "block", "largest", "rare", F.col("entries.id").alias("id"), F.col("entries.weight").alias("weight")), "lists")
    bounds = opened.groupBy("query_id", "block").agg(F.sum(F.col("rare") * F.col("largest")).alias("bound"))
    first = bounds.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))).where("r = 1").select("query_id", "block")
    sure = _ranked(_scores(opened.join(first, ["query_id", "block"]), keep), k).groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("sure"))
    # scores are rounded to six places, so a bound counts as reached a little below
    open_blocks = bounds.join(sure, "query_id", "left").where(F.col("sure").isNull() | (F.col("bound") >= F.col("sure") - 1e-5)).select("query_id", "block")
    return _ranked(_scores(opened.join(open_blocks, ["query_id", "block"]), keep), k)


def _scores(lists: DataFrame, keep: DataFrame | None) -> DataFrame:
    found = lists.select("query_id", "rare", F.explode(F.arrays_zip("id", "weight")).alias("e")).groupBy("query_id", F.col("e.id").alias("id")).agg(F.round(F.sum(F.col("rare") * F.col("e.weight")), 6).alias("score"))
    return found if keep is None else found.join(keep.select("id"), "id", "left_semi")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    ranked = scores.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "id", "score", "rank")


def phrase(index: str, text: str, spark) -> DataFrame:
    """id: the documents in which the words of ``text`` stand one behind the other."""
    terms = [r["t"] for r in spark.range(1).select(F.posexplode(words(F.lit(text))).alias("i", "t")).orderBy("i").collect()]
    asked = spark.createDataFrame(list(enumerate(terms)), "i int, term string")
    rows = spark.read.parquet(f"{index}/postings").join(asked, "term").select("i", F.explode("entries").alias("e"))
    starts = rows.select(F.col("e.id").alias("id"), F.explode("e.places").alias("place"), "i").groupBy("id", (F.col("place") - F.col("i")).alias("start")).agg(F.count("*").alias("n"))
    return starts.where(F.col("n") == len(terms)).select("id").distinct()
