"""Runs of a stream as a table, from what Spark measured of its micro-batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

RUNS = "batch long, started_at timestamp, duration_ms double, rows long"


def measured_runs(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch that read rows: when it began, how long it took, and its rows; M10's input.

    Spark keeps the newest progress reports only
    (``spark.sql.streaming.numRecentProgressUpdates``), so the table is small.
    """
    rows = []
    for p in query.recentProgress:
        if p["numInputRows"]:
            start = dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00"))
            rows.append((p["batchId"], start, float(p["durationMs"].get("triggerExecution", 0)), p["numInputRows"]))
    return spark.createDataFrame(rows, RUNS)
