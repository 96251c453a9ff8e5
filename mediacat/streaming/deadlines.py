"""Task deadlines on a stream of task events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.operators.tasks import MICROS
from mediacat.schemas import INDEX_DEADLINE_SEC, TERMINAL_TASK_STATUSES

ALIVE = "alive"


def deadline_join(
    submitted: DataFrame,
    events: DataFrame,
    deadline_sec: int = INDEX_DEADLINE_SEC,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Stream of (task_id, submitted_at, status, ended_at), one row per task once its outcome is certain.

    For task ids that are submitted once: a submission meets only its own task's few final events, of which the
    first counts. Use `deadline_stream` where one key has many submissions.
    """
    starts = submitted.select("task_id", F.col("ts").alias("submitted_at")).withWatermark("submitted_at", lateness)
    ends = events.filter(F.col("status").isin(*TERMINAL_TASK_STATUSES)).select(
        F.col("task_id").alias("_task_id"), "status", F.col("ts").alias("ended_at")
    )
    ends = ends.withWatermark("ended_at", lateness)
    in_time = F.expr(f"ended_at >= submitted_at AND ended_at < submitted_at + INTERVAL {int(deadline_sec)} SECONDS")
    joined = starts.join(ends, (F.col("task_id") == F.col("_task_id")) & in_time, "left_outer")
    found = F.when(F.col("status").isNotNull(), F.struct("ended_at", "status"))
    first = joined.groupBy("submitted_at", "task_id").agg(F.min(found).alias("_first"))
    return first.select(
        "task_id",
        "submitted_at",
        F.coalesce(F.col("_first.status"), F.lit("timeout")).alias("status"),
        F.col("_first.ended_at").alias("ended_at"),
    )


def deadline_stream(
    events: DataFrame, deadline_sec: int = INDEX_DEADLINE_SEC, lateness: str = "10 minutes", key: str = "task_id", slices: int = 16
) -> DataFrame:
    """Stream of (event_id, key, submitted_at, status, ended_at): each submission once its outcome is certain, append mode.

    For keys with any number of submissions; `events` is a stream of (event_id, key, status, ts). One query of four stateful
    operators, whose state Spark keeps and clears by the watermark. The deadline is cut into `slices`. An aggregate finds the
    first final event of each key and slice. A submission is joined with the final events of its own slice and with the
    first ones of the slices up to its deadline, so it meets at most `slices` + 1 rows besides those of its own slice; a last
    aggregate takes the earliest. Equality on key and slice (or a stretch of slices) deals a key with very many events over
    many tasks. Events behind the watermark are left out and counted in the stream's progress.

    Events with the status `alive` (any key and id, not null) only move the watermark, so that an idle queue's submissions are
    decided too. They pass every filter below, because Spark evaluates filters on other columns before it looks at event times.
    """
    whole = MICROS * int(deadline_sec)
    width = -(-whole // slices)
    stretch = width * (slices + 1)
    marked = events.withWatermark("ts", lateness)
    number = F.floor(F.unix_micros("ts") / width)
    hit = F.when(F.col("status") != ALIVE, F.struct("ts", "event_id", "status"))
    ends = marked.filter(F.col("status").isin(*TERMINAL_TASK_STATUSES, ALIVE))
    starts = marked.filter(F.col("status").isin("submitted", ALIVE))
    starts = starts.select("event_id", key, F.col("ts").alias("submitted_at"), F.col("status").alias("_word"))
    of_start = F.floor(F.unix_micros("submitted_at") / width)
    found = ["event_id", key, "submitted_at", "_word", "_hit"]

    own = ends.select(F.col(key).alias("_key"), number.alias("_slice"), F.col("ts").alias("_ts"), hit.alias("_hit"))
    within = F.expr(f"_ts >= submitted_at AND _ts < submitted_at + INTERVAL {width} MICROSECONDS")
    near = starts.join(own, (F.col(key) == F.col("_key")) & (of_start == F.col("_slice")) & within).select(*found)

    firsts = ends.groupBy(F.col(key).alias("_key"), F.window("ts", f"{width} microseconds").alias("_window")).agg(F.min(hit).alias("_hit"))
    firsts = firsts.select(
        "_key", F.window_time("_window").alias("_ts"), F.floor(F.unix_micros("_window.start") / width).alias("_slice"),
        F.floor(F.unix_micros("_window.start") / stretch).alias("_stretch"), "_hit",
    )
    reached = F.array_distinct(F.array(*(F.floor((F.unix_micros("submitted_at") + F.lit(d)) / stretch) for d in (0, whole))))
    spread = starts.withColumn("_reached", F.explode(reached))
    within = F.expr(f"_ts >= submitted_at AND _ts < submitted_at + INTERVAL {whole + width} MICROSECONDS")
    ahead = (F.col("_slice") > of_start) & (F.unix_micros("_hit.ts") < F.unix_micros("submitted_at") + whole)
    far = spread.join(firsts, (F.col(key) == F.col("_key")) & (F.col("_reached") == F.col("_stretch")) & ahead & within).select(*found)

    nothing = starts.withColumn("_hit", F.lit(None).cast("struct<ts:timestamp,event_id:long,status:string>"))
    first = nothing.unionByName(near).unionByName(far).groupBy("event_id", key, "submitted_at")
    first = first.agg(F.min("_hit").alias("_hit"), F.max("_word").alias("_word")).filter(F.col("_word") == "submitted")
    return first.select(
        "event_id", key, "submitted_at", F.coalesce("_hit.status", F.lit("timeout")).alias("status"), F.col("_hit.ts").alias("ended_at")
    )
