"""Event-time windows over the stream of task events, append mode: a row appears once the watermark has passed its window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_windows(events: DataFrame, width: str = "1 hour", lateness: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Stream of (start, end, status, events, tasks): events and distinct tasks in each tumbling (or sliding) window.

    `events` holds (task_id, status, ts). Distinct tasks are an estimate (HyperLogLog, 2 % standard error), since the state is
    one row per window and status however many tasks there are.
    """
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    counted = events.withWatermark("ts", lateness).groupBy(window.alias("w"), "status").agg(
        F.count(F.lit(1)).alias("events"), F.approx_count_distinct("task_id", 0.02).alias("tasks")
    )
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "status", "events", "tasks")


def task_sessions(events: DataFrame, gap: str = "30 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Stream of (task_id, start, end, events, failed): a task's events with at most `gap` between neighbours are one session.

    `end` is the last event's time plus the gap. The state is one row per open session.
    """
    session = F.session_window("ts", gap)
    counted = events.withWatermark("ts", lateness).groupBy("task_id", session.alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    return counted.select("task_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events", "failed")
