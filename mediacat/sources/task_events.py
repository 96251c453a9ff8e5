"""The task log: an append-only table of (task_id, video_id, status, ts), one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.schemas import TASK_EVENTS, TERMINAL_TASK_STATUSES

STORED = T.StructType([*TASK_EVENTS.fields, T.StructField("day", T.DateType())])


def append_task_events(events: DataFrame, path: str) -> None:
    rows = events.select(*[F.col(f.name).cast(f.dataType) for f in TASK_EVENTS])
    # rows of a day are brought together, and a full day is cut into files of the advisory size
    dated = rows.withColumn("day", F.to_date("ts")).hint("rebalance", "day")
    dated.write.mode("append").partitionBy("day").parquet(path)


def read_task_events(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """Events from day `since` on; earlier folders are not read."""
    events = spark.read.schema(STORED).parquet(path)
    if since:
        events = events.filter(F.col("day") >= F.lit(since).cast("date"))
    return events.drop("day")


def first_deliveries(events: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Stream of the events without repeated deliveries: of equal (task_id, status, ts) within `lateness` the first.

    The state holds one key per event of the last `lateness`, however long the stream runs. A repeat that comes later than that is
    behind the watermark and left out as late; where the stream is idle that long it may pass, and `final_states` counts it once
    for the outcome all the same.
    """
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["task_id", "status", "ts"])


def final_states(log: DataFrame) -> DataFrame:
    """The log compacted to one row per ended task: its first final event, and how many final events it had.

    Partial aggregates only, so a task with very many events sends one row per partition. At one time the first status in the
    order of words counts; repeated deliveries change nothing but `events`.
    """
    ended = log.filter(F.col("status").isin(*TERMINAL_TASK_STATUSES))
    first = F.min(F.struct("ts", "status", "video_id")).alias("first")
    return ended.groupBy("task_id").agg(first, F.count(F.lit(1)).alias("events")).select(
        "task_id", "first.video_id", "first.status", F.col("first.ts").alias("ended_at"), "events"
    )
