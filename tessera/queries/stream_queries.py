"""Batch forms of the event windows, with SQL. An extension beyond the surveyed capabilities."""

from __future__ import annotations

from ..streaming import jobs as J
from ..streaming import windows as W
from ..tables import load, run_sql

#: Batch jobs, one a user, whose states are the user's events.
JOBS = """SELECT user_id AS job, event_id AS ord, ts AS told, CASE event_id % 60 WHEN 7 THEN 'Completed' WHEN 17 THEN 'PartiallyCompleted' WHEN 27 THEN 'Failed' ELSE 'InProgress' END AS status FROM events"""

QUERIES = {
    "job_outcomes": lambda spark, d: J.outcomes(run_sql(spark, d, JOBS).withColumnRenamed("told", "at"), "36 hours").select("job", "status", "succeeded"),
    "window_tumbling": lambda spark, d: W.tumbling(load(spark, d, "events")),
    "window_session": lambda spark, d: W.sessions(load(spark, d, "events")),
}
SQL = {
    "job_outcomes": f"""SELECT CAST(job AS VARCHAR) AS job, arg_min(state, row(told, ord)) AS status, arg_min(state, row(told, ord)) IN ('Completed', 'PartiallyCompleted') AS succeeded
FROM (SELECT job, told, ord, CASE WHEN status = 'InProgress' THEN 'TimedOut' ELSE status END AS state FROM (
SELECT *, coalesce(lead(told) OVER (PARTITION BY job ORDER BY told, ord), max(told) OVER ()) AS next FROM ({JOBS})) WHERE status <> 'InProgress' OR next > told + INTERVAL 36 HOUR) GROUP BY job""",
    "window_tumbling": "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY date_trunc('hour', ts), event_type",
    "window_session": """SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n FROM (
SELECT *, sum(CASE WHEN ts - before < INTERVAL 30 MINUTE THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, s""",
}
