"""Passthrough features over few large groups, by ordered operators: a plain window or percentile is one task a group.

Their SQL is that of ``plans.passthrough``.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ordered as O
from ..tables import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(make):
    QUERIES[make.__name__] = make
    return make


@query
def passthru_percentile(spark, d):
    items = load(spark, d, "lineitem").select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price"))
    found = O.percentiles(items, ["l_returnflag"], "price", {"p50": 0.5, "p97": 0.97})
    # a group without a price has a row too
    groups = items.where("price IS NULL").select(F.col("l_returnflag").alias("flag")).distinct()
    empty = groups.join(found, F.col("flag").eqNullSafe(F.col("l_returnflag")), "left_anti")
    nothing = F.lit(None).cast("double")
    return found.select("l_returnflag", F.round("p50", 6).alias("p50"), F.round("p97", 6).alias("p97")).union(empty.select("flag", nothing, nothing))


@query
def passthru_window_rank(spark, d):
    """Places by price come from running counts over ranges; ranks by priority from the counts of the priorities, a row each."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", price.isNull().alias("priceless"), (-price).alias("less"), F.lit(1).cast("long").alias("one"))
    of_status = Window.partitionBy("status")
    by_priority = of_status.orderBy(F.col("priority").asc_nulls_last())
    kinds = orders.groupBy(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(by_priority.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kinds = kinds.select("status", "priority", (before + 1).alias("rk"), F.row_number().over(by_priority).cast("long").alias("dr"), F.sum("n").over(of_status).alias("size"))
    rows = O.running(orders, ["o_orderstatus"], ["priceless", "less", "o_orderkey"], "one", "rn")
    rows = rows.join(F.broadcast(kinds), F.col("o_orderstatus").eqNullSafe(F.col("status")) & F.col("o_orderpriority").eqNullSafe(F.col("priority")))
    # the first size % 4 quarters have one row more
    nt = F.expr("CASE WHEN rn <= (size % 4) * (size div 4 + 1) THEN (rn - 1) div (size div 4 + 1) + 1 ELSE size % 4 + (rn - (size % 4) * (size div 4 + 1) - 1) div greatest(size div 4, 1) + 1 END")
    pr = F.when(F.col("size") > 1, (F.col("rk") - 1) / (F.col("size") - 1)).otherwise(0.0)
    return rows.select("o_orderkey", "rn", "rk", "dr", nt.alias("nt"), F.round(pr, 9).alias("pr"))
