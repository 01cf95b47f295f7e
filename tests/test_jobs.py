"""Outcomes of batch jobs: from tables against plain Python, and from streams against tables."""

from __future__ import annotations

import datetime as dt
import json

from tessera.streaming import jobs as J

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "job string, ord long, status string, at timestamp"
HOUR = 3_600_000


def at(hours: float) -> str:
    return (T0 + dt.timedelta(hours=hours)).isoformat()


FILES = [
    [("a", 1, "Submitted", 0), ("b", 2, "InProgress", 0.2), ("c", 3, "InProgress", 0.3), ("e", 4, "Failed", 0.4)],
    [("a", 5, "Completed", 1), ("c", 6, "InProgress", 1.1), ("e", 7, "Completed", 1.2), (None, 8, "Completed", 1.2), ("f", 9, None, 1.2)],
    [("c", 10, "PartiallyCompleted", 2), ("a", 11, "Failed", 2.1)],
    [("d", 12, "InProgress", 9)],
    [("b", 13, "Completed", 9.5), ("d", 14, "Stopped", 9.6)],
    [("g", 15, "InProgress", 9.7)],
]
EXPECTED = {("a", "Completed", True), ("b", "TimedOut", False), ("c", "PartiallyCompleted", True), ("d", "Stopped", False), ("e", "Failed", False)}


def test_table(spark):
    rows = [(j, o, s, T0 + dt.timedelta(hours=h)) for f in FILES for j, o, s, h in f]
    found = J.outcomes(spark.createDataFrame(rows, SCHEMA), "3 hours").collect()
    assert {(r.job, r.status, r.succeeded) for r in found} == EXPECTED
    assert len(found) == len(EXPECTED)
    assert J.outcomes(spark.createDataFrame([], SCHEMA), "3 hours").count() == 0


def _put(folder, number: int) -> None:
    lines = [json.dumps({"job": j, "ord": o, "status": s, "at": at(h)}) for j, o, s, h in FILES[number]]
    (folder / f"part{number}.json").write_text("\n".join(lines))


def _run(spark, folder, root) -> None:
    states = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"file://{folder}")
    writer = J.track(states, 3 * HOUR).writeStream.format("parquet").option("path", f"file://{root}/out").option("checkpointLocation", f"file://{root}/check")
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def test_stream_equals_table_over_restarts(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for number in range(len(FILES)):
        _put(folder, number)
        if number % 2:
            _run(spark, folder, tmp_path)
    found = spark.read.parquet(f"file://{tmp_path}/out").collect()
    assert {(r.job, r.status, r.succeeded) for r in found} == EXPECTED
    assert len(found) == len(EXPECTED)
