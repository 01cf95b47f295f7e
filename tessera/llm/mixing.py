"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source has a weight. Together the sources share ``share`` times the words of all documents by weight; no
source gets more than ``max_repeats`` times its own words, and what one can't take is shared again by weight until
none is above (water filling: a level that only rises, each step one sum over the sources).

Within a source the documents are shuffled by a seeded hash. A document's virtual finish time is the words of its
source up to and with it, divided by the source's target; its second copy finishes one whole source later, and so
on. All copies together, in order of finish time, are cut where their words reach the budget (the sum of targets).
So at every point of the mix each source has had its share. A source's words end within a document of its target; where
many sources have a copy at the very time of the cut, a hash decides which of them are still taken.

Plan: sizes and keys are projected once and written without the texts. Running sums in a source of any size come in
two levels: each source is cut by hash into buckets of a few thousand rows, buckets are summed before they
shuffle, a window runs over the buckets, and another within each bucket; no task sees a whole source. The cut is
found without a global sort, from histograms of finish times in a fixed number of bins, refined until a bin holds
few rows; only those are ranked one by one. Where more rows than that finish at one time, histograms of their hashes go on.
Rows equal in source, id and text are numbered (counted by the partition that read them, so that no task meets all of
them), and the number is hashed with them: they spread over the buckets.

Edge cases: a null or empty text has size 0; its copies count no words and stay only with what precedes the cut. A null
source is a source, last in order. Rows with a null weight list of sources can't arise: weights repeat 3, 1, 2 over
the sources in code-point order unless given. A source without words has target 0. If no document has words every
target is 0 and nothing is taken. Of equal finish
times the smaller hash of source, id, text and number comes first. Rows equal in source, id and text are
interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_path, numbered, stored, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
BUCKET_ROWS = 4000
BINS = 4096
RANKED_ROWS = 5000
SEED = 42


def size_of(text: Column) -> Column:
    """The number of runs of other bytes than blank, tab to carriage return; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: source, source_size, target. ``sizes`` has a row a source; no task needs to see all of them."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = numbered(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], "rank")
    ranked, _ = stored(ranked.select("source", "source_size", weight.alias("weight"), (F.lit(float(max_repeats)) * F.col("source_size")).alias("capacity")), "ranked")
    total = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    budget, level = share * float(total["words"] or 0), 0.0
    # the level is what open sources get a weight; each source that it fills raises it for the others, until it fills no more
    while total["weight"]:
        full = F.col("capacity") <= F.lit(level) * F.col("weight")
        row = ranked.agg(F.sum(F.when(full, F.col("capacity"))).alias("filled"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        higher = (budget - (row["filled"] or 0.0)) / row["open"]
        if higher <= level:
            break
        level = higher
    return ranked.select("source", "source_size", F.least(F.col("capacity"), F.lit(level) * F.col("weight")).alias("target"))


def _text_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text", "source")


def _drawn(docs: DataFrame, seed: int) -> tuple[DataFrame, str]:
    """Per row __id, __source, __size, __text (a hash of source, id and text) and __draw, another hash for each row of those equal in them."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("source").alias("__source"), size_of(F.col("text")).alias("__size"), _text_hash(seed).alias("__text"), F.spark_partition_id().alias("__part"))
    rows, path = stored(keyed, "sizes")
    counted = rows.groupBy("__text", "__part").agg(F.count("*").alias("__n"))
    by_text = Window.partitionBy("__text")
    before = F.coalesce(F.sum("__n").over(by_text.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    repeated = counted.withColumns({"__before": before, "__all": F.sum("__n").over(by_text)}).where("__all > 1").select(F.col("__text").alias("__t"), F.col("__part").alias("__p"), "__before")
    marked = rows.join(repeated, (F.col("__text") == F.col("__t")) & (F.col("__part") == F.col("__p")), "left")
    once = marked.where("__before IS NULL").withColumn("__draw", F.col("__text"))
    number = F.row_number().over(Window.partitionBy("__text", "__part").orderBy("__text"))
    again = marked.where("__before IS NOT NULL").withColumn("__draw", F.xxhash64("__text", F.col("__before") + number))
    out, out_path = stored(once.union(again).drop("__t", "__p", "__before", "__part"), "draws")
    drop_path(docs.sparkSession, path)
    return out, out_path


def schedule(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, tuple]:
    """Rows with size, source_size, target and ``finish`` (of the first copy), and the cut.

    The cut is the finish time, draw and source of the first copy that isn't taken, Nones if all are.
    """
    rows, rows_path = _drawn(docs, seed)
    sources, sources_path = stored(rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"), F.count("*").alias("n")), "sources")
    shares = targets(sources, weights=weights, share=share, max_repeats=max_repeats)
    shares = shares.join(sources.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    shares, shares_path = stored(shares.withColumn("buckets", F.ceil(F.col("n") / bucket_rows)), "targets")

    total = rows.join(shares, F.col("__source").eqNullSafe(F.col("source")))
    placed = total.withColumn("__bucket", F.floor((F.shiftrightunsigned("__draw", 1) / F.lit(float(1 << 63))) * F.col("buckets")).cast("long"))
    summed = placed.groupBy("source", "__bucket").agg(F.sum("__size").alias("in_bucket"))
    offsets = summed.withColumn("offset", F.sum("in_bucket").over(Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))).select(F.col("source").alias("s"), F.col("__bucket").alias("b"), F.coalesce("offset", F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "__bucket").orderBy(F.shiftrightunsigned("__draw", 1), "__draw")
    running = placed.withColumn("__sum", F.sum("__size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    timed = running.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("__bucket") == F.col("b"))).withColumn("__cum", F.col("__sum") + F.col("offset"))
    timed = timed.select("__id", "__source", "__size", "__draw", "__text", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), "__cum", F.when(F.col("target") > 0, F.col("__cum") / F.col("target")).alias("__finish"))
    timed, _ = stored(timed, "finish")
    for path in (rows_path, sources_path, shares_path):
        drop_path(docs.sparkSession, path)
    return timed, _cut(timed, max_repeats)


def _copies(timed: DataFrame, max_repeats: int) -> DataFrame:
    """A row for each copy that may be taken, with its finish time."""
    copies = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("__copy")
    again = timed.where("__size > 0 AND __target > 0").select("*", copies)
    return again.withColumn("__at", F.col("__finish") + F.col("__copy") * F.col("__source_size") / F.col("__target"))


def _refined(copies: DataFrame, value: str, low: float, width: float, before: int, budget: float, most: int) -> tuple[float, float, int, int] | None:
    """Of BINS bins of ``value`` from ``low``, refined while more than ``most`` copies, of more than one value, are in it, the one in which the words pass the budget.

    Returns its beginning, its width, the words before it and its copies; None if all words stay within the budget.
    """
    while True:
        inside = copies.where((F.col(value) >= low) & (F.col(value) < low + BINS * width))
        bins = F.floor((F.col(value) - F.lit(low)) / F.lit(width)).cast("long")
        counted = inside.groupBy(bins.alias("bin")).agg(F.sum("__size").alias("words"), F.count("*").alias("n"), (F.min(value) < F.max(value)).alias("differ"))
        for row in counted.orderBy("bin").collect():
            if before + row["words"] > budget:
                break
            before += row["words"]
        else:
            return None
        low += row["bin"] * width
        if row["n"] <= most or not row["differ"] or low + width / BINS == low:
            return low, width, before, row["n"]
        width /= BINS


def _cut(timed: DataFrame, max_repeats: int, most: int | None = None) -> tuple:
    most, everything = RANKED_ROWS if most is None else most, (None,) * 3
    copies = _copies(timed, max_repeats)
    top = copies.agg(F.max("__at")).first()[0]
    budget = timed.select("__source", "__target").distinct().agg(F.sum(F.col("__target").cast("decimal(30,6)"))).first()[0]
    if not top:
        return everything
    # widths are powers of two, so that a bin's edges are exact
    budget, width = float(budget), 2.0 ** (math.floor(math.log2(top / BINS)) + 1)
    found = _refined(copies, "__at", 0.0, width, 0, budget, most)
    if found is None:
        return everything
    low, width, before, n = found
    copies = copies.where((F.col("__at") >= low) & (F.col("__at") < low + width))
    if n > most:  # these finish at one time: go on by their hashes, 12 bits a pass
        drawn = copies.withColumn("__high", F.shiftrightunsigned("__draw", 12).cast("double"))
        low, width, before, n = _refined(drawn, "__high", 0.0, 2.0**40, before, budget, most)
        copies = drawn.where((F.col("__high") >= low) & (F.col("__high") < low + width)).drop("__high")
    order = _order()
    running = copies.withColumn("__words", F.sum("__size").over(Window.partitionBy(F.lit(0)).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    row = running.where(F.col("__words") + before > budget).orderBy(*order).select("__at", "__draw", "__source").first()
    return tuple(row) if row else everything


def _order() -> list[Column]:
    return [F.col("__at"), F.shiftrightunsigned("__draw", 12), F.col("__draw"), F.col("__source").asc_nulls_last()]


def _taken(at: Column, cut: tuple) -> Column:
    """Whether a copy stands before the cut in the global order."""
    cut_at, draw, source = cut
    if cut_at is None:
        return F.lit(True)
    mine = F.struct(F.shiftrightunsigned("__draw", 12), F.col("__draw"), F.col("__source").isNull(), F.coalesce(F.col("__source"), F.lit("")))
    theirs = F.struct(F.shiftrightunsigned(F.lit(draw).cast("long"), 12), F.lit(draw).cast("long"), F.lit(source is None), F.lit(source or ""))
    return (at < cut_at) | ((at == cut_at) & (mine < theirs))


def assignment(docs: DataFrame, *, max_repeats: int = MAX_REPEATS, **options) -> DataFrame:
    """Per document row the columns ``__*`` of the schedule, and ``__copies``: how often the mix takes it."""
    timed, where = schedule(docs, max_repeats=max_repeats, **options)
    copies = F.lit(0)
    for k in range(max_repeats):
        at = F.col("__finish") + k * F.col("__source_size") / F.col("__target")
        copies = copies + F.when((F.col("__target") > 0) & _taken(at, where), 1).otherwise(0)
    return timed.withColumn("__copies", copies)


def mix(docs: DataFrame, *, seed: int = SEED, **options) -> DataFrame:
    """The mix: rows of ``docs``, each as often as it is taken, in order of their finish times (a range sort).

    Texts stay out of the schedule and join its result by id, hash and source. Rows equal in all three share what is
    taken of them evenly; what is left over goes to one of them. Their copies stand anywhere between the finish times
    of the first and the last of them.
    """
    key = ["__id", "__text", "__source"]
    keys = assignment(docs, seed=seed, **options).groupBy(*key, "__source_size", "__target").agg(F.count("*").alias("__n"), F.sum("__copies").alias("__total"), F.min("__finish").alias("__first"), F.max("__finish").alias("__last"))
    keys = keys.where("__total > 0").withColumns({"__each": F.expr("__total div __n"), "__left": F.expr("__total % __n")})
    rows = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long").alias("__k"), _text_hash(seed).alias("__d"), F.col("source").alias("__s"))
    rows = rows.join(stored(keys, "taken")[0], F.col("__k").eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__text")) & F.col("__s").eqNullSafe(F.col("__source"))).drop("__k", "__d", "__s")
    copies = lambda first, n: F.explode(F.sequence(first, first + n - 1)).alias("__copy")
    taken = rows.where("__each > 0").select("*", copies(F.lit(0).cast("long"), F.col("__each")))
    more = rows.where("__left > 0").dropDuplicates(key).select("*", copies(F.col("__each"), F.col("__left")))
    between = F.col("__first") + F.when(F.col("__last") > F.col("__first"), F.rand(seed) * (F.col("__last") - F.col("__first"))).otherwise(0.0)
    out = taken.union(more).withColumn("__at", between + F.least("__copy", "__each") * F.col("__source_size") / F.col("__target"))
    return out.orderBy("__at", "__text").select("__row.*")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = assignment(table(spark, sf_dir, "documents"))
    return timed.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).cast("long").alias("taken"))
