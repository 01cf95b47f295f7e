"""Packing requests into jobs by count and bytes, as a greedy pass over them would, without such a pass.

A job takes requests in order until one more would make it too many or too large. So where a job begins decides where
the next one begins, and that is a function of each request alone: the first place at which the running sum of sizes
exceeds what was there before the request plus the limit. All these places are found at once, by merging the running
sums with the sums asked for. The jobs' beginnings are the places that this function leads to from the first request, again
and again; they are found by doubling: each round knows twice as many of them, and the function applied twice as often.

Plan: a range sort by the given order, sums in two levels, a range sort of two numbers a request, and one join of a
request's two numbers with themselves a round; rounds grow as the logarithm of the number of jobs. Nothing is collected but
the last two beginnings. A job is spread out to its rows at the end; that is as many rows as a job may have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import drop_path, numbered, stored

BLOCK = 4096


def with_sums(placed: DataFrame, size: str) -> DataFrame:
    """``placed`` (with ``place``) and ``before``, the sum of ``size`` of all rows before; blocks are summed first."""
    rows = placed.withColumn("__block", F.floor(F.col("place") / BLOCK))
    blocks = rows.groupBy("__block").agg(F.sum(size).alias("__sum"))
    offset = F.coalesce(F.sum("__sum").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = F.coalesce(F.sum(size).over(Window.partitionBy("__block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("__inner", inner).join(blocks.select("__block", offset.alias("__offset")), "__block").withColumn("before", F.col("__offset") + F.col("__inner")).drop("__block", "__inner", "__offset")


def next_starts(sums: DataFrame, max_records: int, max_bytes: int) -> DataFrame:
    """place, next: where the job after one that begins at ``place`` begins (place, size, before in).

    Sums behind each row and the sums asked for are put in one order; before the question of the row at place i stand i
    questions, and as many rows as still fit.
    """
    held = sums.select((F.col("before") + F.col("size")).alias("sum"), F.lit(0).alias("asks"), "place")
    asked = sums.select((F.col("before") + max_bytes).alias("sum"), F.lit(1).alias("asks"), "place")
    merged = numbered(held.union(asked), ["sum", "asks", "place"], "at").where("asks = 1")
    fits = F.greatest(F.col("at") - F.col("place"), F.col("place") + 1)  # a request too large for any job has one alone
    return merged.select("place", F.least(fits, F.col("place") + max_records).alias("next"))


def starts_from(following: DataFrame) -> DataFrame:
    """place: the beginnings of jobs, from place 0 by ``next``, found by doubling."""
    spark = following.sparkSession
    jumps, jumps_path = stored(following.select("place", "next"), "jumps")
    n = jumps.count()
    starts, starts_path = stored(jumps.where("place = 0").select("place"), "starts")
    while True:
        ahead = starts.join(jumps, "place").where(F.col("next") < n).select(F.col("next").alias("place"))
        new, new_path = stored(starts.union(ahead), "starts")
        if new.count() == starts.count():
            return starts
        twice = jumps.join(jumps.select(F.col("place").alias("next"), F.col("next").alias("further")), "next")
        twice, twice_path = stored(twice.select("place", F.col("further").alias("next")), "jumps")
        for path in (starts_path, jumps_path):
            drop_path(spark, path)
        starts, starts_path, jumps, jumps_path = new, new_path, twice, twice_path


def pack_jobs(requests: DataFrame, order: list[str], size: str, max_records: int, max_bytes: int, min_records: int) -> DataFrame:
    """``requests`` with their ``place`` (from 0, by ``order``) and ``job`` (from 1).

    A job has at most ``max_records`` requests and ``max_bytes`` of ``size``, but one alone may be larger. If the last has fewer than
    ``min_records``, the last two are halved. A null size counts 0; ``order`` must be total, or equal requests may change places.
    """
    if max_records < 1:
        raise ValueError("max_records must be at least 1")
    placed, _ = stored(numbered(requests, order).withColumn("__size", F.coalesce(F.col(size).cast("long"), F.lit(0))), "placed")
    sums, _ = stored(with_sums(placed.select("place", F.col("__size").alias("size")), "size"), "sums")
    starts = numbered(starts_from(next_starts(sums, max_records, max_bytes)), ["place"], "job")
    starts, _ = stored(starts, "jobs")
    n = placed.count()
    last = [r["place"] for r in starts.orderBy(F.desc("place")).limit(2).collect()]
    ends = starts.join(starts.select((F.col("job") - 1).alias("job"), F.col("place").alias("end")), "job", "left")
    spread = ends.select(F.explode(F.sequence("place", F.coalesce("end", F.lit(n)) - 1)).alias("place"), (F.col("job") + 1).alias("job"))
    if len(last) == 2 and n - last[0] < min_records:
        half = last[1] + (n - last[1]) // 2
        jobs = starts.count()
        spread = spread.withColumn("job", F.when(F.col("place") < last[1], F.col("job")).otherwise(F.when(F.col("place") < half, jobs - 1).otherwise(jobs)))
    return placed.drop("__size").join(spread, "place")
