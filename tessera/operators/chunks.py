"""Sentences, windows, cosine distances, percentile cuts, chunks, and the packing of batch jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import stored
from .ordered import following, percentile as exact_percentile, running
from .retrieval import cosine

SIZE, OVERLAP, BUFFER, PERCENTILE = 7900, 100, 3, 97
SENTENCE = r"(?<=[.!?])\s+"


def sentences(text: Column) -> Column:
    """The sentences of a text, in order: cut after ``.``, ``!`` or ``?`` before white space; none of an empty text."""
    return F.filter(F.split(text, SENTENCE), lambda s: s != "")


def sentence_rows(docs: DataFrame) -> DataFrame:
    """doc_id, i (from 0), sentence."""
    return docs.select("doc_id", F.posexplode(sentences(F.col("text"))).alias("i", "sentence"))


def windows(docs: DataFrame, buffer: int = BUFFER) -> DataFrame:
    """Each sentence with ``buffer`` sentences on either side as one text, and its token ``doc:window``.

    Windows are made in the row of their document: no shuffle.
    """

    def window(s: Column, i: Column) -> Column:
        begin = F.greatest(i - buffer, F.lit(0))
        return F.array_join(F.slice(s, begin + 1, i + buffer - begin + 1), " ")

    rows = docs.select("doc_id", F.posexplode(_each_place(sentences(F.col("text")), F.size, window)).alias("i", "text"))
    return rows.select("doc_id", "i", "text", F.concat_ws(":", "doc_id", "i").alias("token"))


def _each_place(parts: Column, number, make) -> Column:
    """The texts that ``make`` gives of all parts at places 0 to ``number`` of them; the parts are bound once and stay in their row."""
    places = lambda s: F.when(F.size(s) > 0, F.sequence(F.lit(0), number(s) - 1))
    return F.transform(F.array(parts), lambda s: F.transform(places(s), lambda i: make(s, i)))[0]


def distances(vectors: DataFrame, group: str, order: str, vector: str) -> DataFrame:
    """1 - cosine of each vector and the next of its group; one fewer than the group has vectors. A group may be of any size."""
    pairs = following(vectors.select(group, order, vector), [group], [order], vector, "__next")
    return pairs.where(f"__next.{vector} IS NOT NULL").select(group, order, F.round(1 - cosine(F.col(vector), F.col("__next")[vector]), 6).alias("distance"))


def breaks(found: DataFrame, group: str, percentile: float = PERCENTILE) -> DataFrame:
    """The distances above the group's percentile, exact and interpolated; a cut comes after each."""
    found, _ = stored(found, "distances")
    levels = exact_percentile(found, [group], "distance", percentile / 100)
    return found.join(levels.withColumnRenamed(group, "__group"), F.col(group).eqNullSafe(F.col("__group"))).drop("__group").withColumn("is_break", F.col("distance") > F.col("level"))


def cuts_of(vectors: str, percentile: float = PERCENTILE) -> Column:
    """Of an array of vectors the places (from 0) after which to cut: where the distance to the next is above the array's percentile."""
    pair = lambda v: lambda i: F.round(1 - cosine(v[i], v[i + 1]), 6)
    places = lambda v: F.when(F.size(v) > 1, F.sequence(F.lit(0), F.size(v) - 2)).otherwise(F.array().cast("array<int>"))

    def level(d: Column) -> Column:
        return _bound(F.array_sort(F.filter(d, lambda x: x.isNotNull())), lambda s: _bound(F.lit(percentile / 100) * (F.size(s) - 1), lambda at: F.get(s, F.floor(at).cast("int")) + (F.get(s, F.ceil(at).cast("int")) - F.get(s, F.floor(at).cast("int"))) * (at - F.floor(at))))

    def above(d: Column) -> Column:
        return _bound(level(d), lambda bar: F.filter(F.transform(d, lambda x, i: F.when(x > bar, i)), lambda i: i.isNotNull()))

    return _bound(F.col(vectors), lambda v: _bound(F.transform(places(v), pair(v)), above))


def parts_between(parts: str, cuts: Column) -> Column:
    """The chunks (text, n) of an array of texts, cut after the places; one empty chunk of none."""
    n = F.coalesce(F.size(parts), F.lit(0))
    n = F.greatest(n, F.lit(0))
    ends = F.concat(cuts, F.array(n - 1))

    def chunk(e: Column):
        def make(end: Column, k: Column) -> Column:
            begin = F.when(k == 0, F.lit(0)).otherwise(F.get(e, k - 1) + 1)
            text = F.when(end < begin, F.lit("")).otherwise(F.array_join(F.slice(F.col(parts), begin + 1, F.greatest(end - begin + 1, F.lit(0))), " "))
            return F.struct(text.alias("text"), F.greatest(end - begin + 1, F.lit(0)).alias("n"))

        return make

    return _bound(ends, lambda e: F.transform(e, chunk(e)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, as the one element of an array."""
    return F.transform(F.array(value), use)[0]


def chunks(rows: DataFrame, cuts: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """The texts between cuts, in order. ``cuts``: group, order of the rows after which a chunk ends. ``order`` numbers the rows of a group."""
    ended = cuts.select(F.col(group).alias("__group"), F.col(order).alias("__order"), F.lit(1).cast("long").alias("__cut"))
    marked = rows.join(ended, F.col(group).eqNullSafe(F.col("__group")) & (F.col(order) == F.col("__order")), "left").drop("__group", "__order")
    numbered = running(marked, [group], [order], "__cut", "__cuts").withColumn("chunk", F.col("__cuts") - F.coalesce("__cut", F.lit(0)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), " ")
    return numbered.groupBy(group, "chunk").agg(joined.alias("text"), F.count("*").alias("n"))


def sentence_chunks(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Greedy chunks of whole sentences of at most ``size`` characters; the last ones that fit ``overlap`` begin the next.

    The unit is characters. A sentence longer than ``size`` is a chunk of its own. Packing is a fold over the
    sentences of a row.
    """
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"))
    width = lambda parts: F.aggregate(parts, F.lit(0), lambda n, s: n + F.length(s) + 1)

    def step(state, sentence):
        fits = width(state["open"]) + F.length(sentence) <= size
        reversed_open = F.reverse(state["open"])
        tail = F.aggregate(
            reversed_open,
            F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("on")),
            lambda t, s: F.struct(
                F.when(t["on"] & (t["n"] + F.length(s) <= overlap), F.concat(F.array(s), t["kept"])).otherwise(t["kept"]).alias("kept"),
                (t["n"] + F.length(s) + 1).alias("n"),
                (t["on"] & (t["n"] + F.length(s) <= overlap)).alias("on"),
            ),
            lambda t: t["kept"],
        )
        closed = (F.size(state["open"]) > 0) & ~fits
        return F.struct(
            F.when(closed, F.concat(state["done"], F.array(F.array_join(state["open"], " ")))).otherwise(state["done"]).alias("done"),
            F.when(closed, F.concat(tail, F.array(sentence))).otherwise(F.concat(state["open"], F.array(sentence))).alias("open"),
        )

    packed = F.aggregate(sentences(F.col("text")), start, step, lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(F.array_join(s["open"], " ")))).otherwise(s["done"]))
    return docs.select("doc_id", F.posexplode(packed).alias("chunk", "text"))


def fixed_chunks(docs: DataFrame, words: int = 300, overlap: float = 0.2) -> DataFrame:
    """Chunks of ``words`` words, each beginning where the one before has ``overlap`` of its words left."""
    step = words - int(words * overlap)
    parts = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    number = lambda w: F.greatest(F.ceil((F.size(w) - words) / step), F.lit(0)).cast("int") + 1
    return docs.select("doc_id", F.posexplode(_each_place(parts, number, lambda w, i: F.array_join(F.slice(w, i * step + 1, words), " "))).alias("chunk", "text"))


def pack_counts(n: int, max_records: int, min_records: int) -> list[int]:
    """Sizes of jobs for ``n`` requests by count: full jobs, and an undersized last one evened out with the one before."""
    sizes = [max_records] * (n // max_records) + ([n % max_records] if n % max_records else [])
    if len(sizes) > 1 and sizes[-1] < min_records:
        both = sizes[-2] + sizes[-1]
        sizes[-2:] = [both // 2, both - both // 2]
    return sizes


def job_numbers(rows: DataFrame, order: str, max_records: int, min_records: int) -> DataFrame:
    """Requests with their job by count, from 1: window arithmetic over positions (``place``, from 0) and their number."""
    n = rows.agg(F.count("*").alias("__n"), F.lit(1).alias("__one"))
    full = F.floor((F.col("__n") - 1) / max_records)
    rest = F.col("__n") - full * max_records
    merged = (rest < min_records) & (full > 0)
    job = F.floor(F.col(order) / max_records)
    half = F.floor((max_records + rest) / 2)
    in_tail = F.col(order) - (full - 1) * max_records
    placed = F.when(merged & (job >= full - 1), full - 1 + F.when(in_tail < half, 0).otherwise(1)).otherwise(job)
    return rows.withColumn("__one", F.lit(1)).join(n, "__one").withColumn("job", (placed + 1).cast("long")).drop("__one", "__n")


def reattach(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Every request with its result: the last of a repeated token; a request without one gets an error row.

    ``requests``: place, token. ``results``: token, ord, embedding, error.
    """
    last = results.groupBy("token").agg(F.max_by(F.struct("embedding", "error"), "ord").alias("r"))
    joined = requests.join(last, "token", "left")
    return joined.select("place", "token", F.col("r.embedding").alias("embedding"), F.when(F.col("r").isNull(), F.lit("no result")).otherwise(F.col("r.error")).alias("error"))


def assert_complete(rows: DataFrame) -> DataFrame:
    """The rows, or an error when any of them failed."""
    return rows.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("failed: "), F.col("error"))).cast("string")))
