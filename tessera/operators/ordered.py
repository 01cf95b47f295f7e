"""Running values, neighbours, as-of and interval joins in an order, of groups of any size.

A window over a group is one task, however large the group. Here rows are dealt by ranges of group and order, so that a
large group lies in many ranges, and written once. Windows then run within a range's share of a group. What a share
needs from those before it (or the row behind it) comes from a summary of a row for each share; only groups that reach
over the edge of a range have something to hand on, so at most as many rows as there are ranges are handed on, and that
is what is broadcast.

``keys`` may be null (nulls are one group, as in windows). ``order`` must be total for a defined result: of rows that
are equal in it, any may come first.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import stored

RANGE, PLACE = "__range", "__place"


def deal(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` by ranges of keys and order, written once with their range and place."""
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(width, *keys, *order).sortWithinPartitions(*keys, *order)
    return stored(dealt.withColumns({RANGE: F.spark_partition_id(), PLACE: F.monotonically_increasing_id()}), "ordered")[0]


def _share(keys: list[str]):
    return Window.partitionBy(RANGE, *keys).orderBy(PLACE)


def _handed_on(dealt: DataFrame, keys: list[str], summary: Column, across) -> DataFrame:
    """Range, keys and ``__given``: what ``across`` makes of the summaries of the group's other shares, where there is something."""
    shares = dealt.groupBy(RANGE, *keys).agg(summary.alias("__sum"))
    given = shares.withColumn("__given", across(F.col("__sum"), Window.partitionBy(*keys).orderBy(RANGE))).where("__given IS NOT NULL")
    return F.broadcast(given.select(F.col(RANGE).alias("__key_range"), *[F.col(k).alias(f"__key_{k}") for k in keys], "__given"))


def _with_given(dealt: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys], F.col(RANGE) == F.col("__key_range"))
    return dealt.join(given, same, "left").drop("__key_range", *[f"__key_{k}" for k in keys])


def _before(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def running(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of their group up to and with themselves (nulls count as 0)."""
    dealt = deal(rows, keys, order)
    given = _handed_on(dealt, keys, F.sum(value), lambda x, w: F.sum(x).over(_before(w)))
    inside = F.coalesce(F.sum(value).over(_share(keys).rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    out = _with_given(dealt.withColumn(name, inside), given, keys)
    return out.withColumn(name, F.col(name) + F.coalesce("__given", F.lit(0))).drop(RANGE, PLACE, "__given")


def carried(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the last ``value`` that isn't null of the rows of their group up to and with themselves."""
    dealt = deal(rows, keys, order)
    last = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(PLACE)))
    given = _handed_on(dealt, keys, last, lambda x, w: F.last(x, ignorenulls=True).over(_before(w)))
    inside = F.last(value, ignorenulls=True).over(_share(keys).rowsBetween(Window.unboundedPreceding, 0))
    return _with_given(dealt.withColumn(name, inside), given, keys).withColumn(name, F.coalesce(name, "__given")).drop(RANGE, PLACE, "__given")


def following(rows: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with a struct of ``value`` of the next row of their group; null for the group's last row."""
    dealt = deal(rows, keys, order)
    given = _handed_on(dealt, keys, F.min_by(F.struct(value), PLACE), lambda x, w: F.lead(x).over(w))
    inside = F.lead(F.struct(value)).over(_share(keys))
    return _with_given(dealt.withColumn(name, inside), given, keys).withColumn(name, F.coalesce(name, "__given")).drop(RANGE, PLACE, "__given")


def percentile(rows: DataFrame, keys: list[str], value: str, share: float, name: str = "level") -> DataFrame:
    """Keys and the exact percentile (``share`` from 0 to 1, interpolated) of each group's values that aren't null."""
    return percentiles(rows, keys, value, {name: share})


def percentiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Keys and exact percentiles (each name's share from 0 to 1, interpolated) of each group's values that aren't null.

    Equal values are counted first; running counts over ranges of the values then find the two ranks around each share.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    ranked = running(counted, keys, [value], "__n", "__upto")
    sizes = counted.groupBy(*keys).agg(F.sum("__n").alias("__size")).select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__size")
    both = ranked.join(sizes, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]))
    holds = lambda rank: (F.col("__upto") - F.col("__n") < rank) & (rank <= F.col("__upto"))
    at = {name: F.lit(share) * (F.col("__size") - 1) for name, share in shares.items()}
    near = {name: holds(F.floor(x) + 1) | holds(F.ceil(x) + 1) for name, x in at.items()}
    values = [f(F.when(near[name], F.col(value))).alias(f"__{end}_{name}") for name in shares for end, f in (("low", F.min), ("high", F.max))]
    ends = both.where(reduce(or_, near.values())).groupBy(*keys, "__size").agg(*values)
    between = lambda name: F.col(f"__low_{name}") + (F.col(f"__high_{name}") - F.col(f"__low_{name}")) * (at[name] - F.floor(at[name]))
    return ends.select(*keys, *[between(name).alias(name) for name in shares])


def asof(left: DataFrame, right: DataFrame, by: list[str], on: str, take: str, ties: list[str], name: str) -> DataFrame:
    """Each row of ``left`` with ``take`` of the last row of ``right`` that is equal in ``by`` and not later in ``on``.

    Of rows of ``right`` at one time, the last by ``ties`` counts. Rows of ``left`` that find none, or are null in ``by``
    or ``on``, get null. Both sides are put into one order, and values are carried along: one sort, no join of the sides.
    """
    found = right.where(reduce(and_, [F.col(c).isNotNull() for c in [*by, on]]))
    asked = left.select(*by, on, F.lit(1).alias("__side"), *[F.lit(None).cast(right.schema[t].dataType).alias(f"__tie{i}") for i, t in enumerate(ties)], F.struct(*[F.col(c) for c in left.columns]).alias("__left"))
    offered = found.select(*by, on, F.lit(0).alias("__side"), *[F.col(t).alias(f"__tie{i}") for i, t in enumerate(ties)], F.struct(F.col(take).alias("v")).alias("__right"))
    both = offered.unionByName(asked, allowMissingColumns=True)
    out = carried(both, by, [on, "__side", *[f"__tie{i}" for i in range(len(ties))]], "__right", "__found").where("__side = 1")
    return out.select("__left.*", F.col("__found.v").alias(name))


def count_between(asked: DataFrame, points: DataFrame, by: list[str], id_: str, low: str, high: str, at: str, name: str) -> DataFrame:
    """``id_`` of each row of ``asked`` and the number of ``points`` equal in ``by`` with ``at`` from ``low`` to ``high``, both included.

    A row that is null in ``by`` or an end, or whose ends are the wrong way round, has 0. ``id_`` must be distinct. The
    points up to either end are counted in one order and subtracted, so no pair of row and point is made.
    """
    valid = reduce(and_, [F.col(c).isNotNull() for c in [*by, low, high]], F.col(low) <= F.col(high))
    kept = asked.where(valid)
    nothing = F.lit(None).cast(asked.schema[id_].dataType)
    marks = points.where(F.col(at).isNotNull()).select(*by, F.col(at).alias("__at"), F.lit(1).alias("__kind"), nothing.alias(id_), F.lit(1).cast("long").alias("__one"))
    for end, kind in ((low, 0), (high, 2)):
        marks = marks.unionByName(kept.select(*by, F.col(end).alias("__at"), F.lit(kind).alias("__kind"), id_, F.lit(0).cast("long").alias("__one")))
    counted = running(marks, by, ["__at", "__kind"], "__one", "__upto").where("__kind <> 1")
    totals = counted.groupBy(id_).agg(F.sum(F.when(F.col("__kind") == 2, F.col("__upto")).otherwise(-F.col("__upto"))).alias(name))
    return totals.union(asked.where(~F.coalesce(valid, F.lit(False))).select(id_, F.lit(0).cast("long").alias(name)))


def pairs_between(asked: DataFrame, points: DataFrame, by: list[str], low: str, high: str, at: str, width: float) -> DataFrame:
    """All columns of both for each pair equal in ``by`` with the number ``at`` from ``low`` to ``high``, both included.

    The sides meet in bins of ``width`` and the exact ends decide there. A row of ``asked`` goes to each bin that it
    touches, a point to its own, so each pair meets once; a width near the usual length of an interval is best. Names
    of columns other than ``by`` must differ between the sides.
    """
    bin_of = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    spread = asked.where(F.col(low) <= F.col(high)).withColumn("__bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    return spread.join(points.withColumn("__bin", bin_of(at)), [*by, "__bin"]).where(F.col(at).between(F.col(low), F.col(high))).drop("__bin")
