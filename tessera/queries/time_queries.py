"""Joins in time over all users of the events, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered as O
from ..tables import load

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(make):
        QUERIES[make.__name__] = make
        SQL[make.__name__] = sql
        return make

    return add


@query("""SELECT p.event_id, v.event_id AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') p
JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts) v ON v.user_id = p.user_id AND v.ts <= p.ts
QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v.ts DESC) = 1""")
def passthru_asof(spark, d):
    """The last view of a user before (or with) each purchase."""
    events = load(spark, d, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    return O.asof(bought, seen, ["user_id"], "ts", "event_id", ["event_id"], "last_view").where("last_view IS NOT NULL").select("event_id", "last_view")


@query("""SELECT a.event_id, count(b.event_id) AS near FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 1 HOUR AND a.ts AND b.event_id <> a.event_id
GROUP BY a.event_id""")
def passthru_range_join(spark, d):
    """How many other events a user has in the hour up to each event."""
    events = load(spark, d, "events").select("event_id", "user_id", "ts")
    asked = events.withColumn("since", F.expr("ts - INTERVAL 1 HOUR"))
    counts = O.count_between(asked, events, ["user_id"], "event_id", "since", "ts", "ts", "within")
    return counts.select("event_id", F.greatest(F.col("within") - 1, F.lit(0)).alias("near"))


@query("""SELECT e.event_id AS error_id, c.event_id AS click_id FROM events e JOIN events c ON e.user_id = c.user_id AND c.ts BETWEEN e.ts - INTERVAL 30 MINUTE AND e.ts + INTERVAL 30 MINUTE
WHERE e.event_type = 'error' AND c.event_type = 'click'""")
def passthru_interval_join(spark, d):
    """Errors with the clicks of their user in the half hour before and after."""
    events = load(spark, d, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    half = 30 * 60 * 1_000_000
    errors = events.where("event_type = 'error'").select(F.col("event_id").alias("error_id"), "user_id", (F.col("at") - half).alias("low"), (F.col("at") + half).alias("high"))
    clicks = events.where("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", "at")
    return O.pairs_between(errors, clicks, ["user_id"], "low", "high", "at", 2 * half).select("error_id", "click_id")
