"""Processing tasks: final states, deadlines, stage times, batch progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediacat.operators.catalog import latest_per_key
from mediacat.operators.joins import spread_join
from mediacat.operators.running import running_totals
from mediacat.schemas import INDEX_DEADLINE_SEC, SUCCESS_STATUSES, TERMINAL_TASK_STATUSES

MICROS = 1_000_000


def first_terminal(
    events: DataFrame,
    key: str = "task_id",
    extra: Sequence[str] = (),
    terminal: Sequence[str] = TERMINAL_TASK_STATUSES,
) -> DataFrame:
    """The earliest final event per task, with further columns of that event."""
    ended = events.filter(F.col("status").isin(*terminal))
    order = ["ts", *(["event_id"] if "event_id" in events.columns else []), "status", *extra]
    first = latest_per_key(ended, [F.asc(c) for c in order], key)
    return first.select(key, "status", F.col("ts").alias("ended_at"), *extra)


def task_status(
    submitted: DataFrame,
    events: DataFrame,
    key: str = "task_id",
    extra: Sequence[str] = (),
    missing: str = "pending",
    terminal: Sequence[str] = TERMINAL_TASK_STATUSES,
) -> DataFrame:
    """Submitted tasks with their final status, or the word `missing` while there is none."""
    joined = spread_join(submitted, first_terminal(events, key, extra, terminal), key, "left")
    return joined.withColumn("status", F.coalesce("status", F.lit(missing)))


def submission_outcome(
    wanted: DataFrame, events: DataFrame, key: str, now: Column, deadline_sec: int = INDEX_DEADLINE_SEC
) -> DataFrame:
    """What became of the latest submission of each `key` in `wanted`, one row per distinct key.

    `events` holds (key, task_id, video_id, status, ts); the key is needed on `submitted` and `upload_failed` events only, ends are
    found by their task. Statuses: ready or failed by the first end before the deadline; upload_failed; timeout
    once `now` has reached the deadline, whatever ends later; indexing while the task may still end in time; pending while
    nothing is submitted. The log is cut down to the wanted keys and then to their tasks before anything is grouped.
    """
    keys = wanted.select(key).distinct()
    handed_in = events.filter(F.col("status").isin("submitted", "upload_failed"))
    handed_in = spread_join(handed_in.select(key, "task_id", "status", "ts"), keys, key, "left_semi")
    latest = latest_per_key(handed_in, [F.desc("ts"), F.desc("task_id"), F.desc("status")], key).select(
        key, "task_id", F.col("status").alias("_handed"), F.col("ts").alias("submitted_at")
    )
    ends = events.filter(F.col("status").isin(*TERMINAL_TASK_STATUSES)).select("task_id", "video_id", "status", "ts")
    ends = spread_join(ends, latest.select("task_id"), "task_id", "left_semi")
    first = latest_per_key(ends, [F.asc("ts"), F.asc("status"), F.asc("video_id")], "task_id")
    first = first.select("task_id", "video_id", F.col("status").alias("_end"), F.col("ts").alias("ended_at"))
    joined = spread_join(keys.join(latest, key, "left"), first, "task_id", "left")
    due = F.col("submitted_at") + F.make_dt_interval(secs=F.lit(deadline_sec))
    in_time = F.coalesce(F.col("ended_at") < due, F.lit(False)) & (F.col("ended_at") <= now)
    status = (
        F.when(F.col("_handed").isNull(), "pending")
        .when(F.col("_handed") == "upload_failed", "upload_failed")
        .when(in_time, F.col("_end"))
        .when(now >= due, "timeout")
        .otherwise("indexing")
    )
    return joined.select(
        key, "task_id", F.when(in_time, F.col("video_id")).alias("video_id"), status.alias("status"), "submitted_at",
        F.when(in_time, F.col("ended_at")).alias("ended_at"),
    )


def task_deadline(
    events: DataFrame,
    deadline_sec: int = INDEX_DEADLINE_SEC,
    key: str = "task_id",
    slice_sec: int = 60,
) -> DataFrame:
    """Each submission with its first ready or failed event in [submitted, submitted + deadline), else `timeout`.

    `events` holds (event_id, key, status, ts) with statuses submitted, ready, failed and others. What follows a submission
    depends on its time alone, so events are first reduced to one row per key and time, with partial aggregates. Time is
    cut into slices: the first final event from a time on is either in its own slice or the first one of a later slice. So
    no pairs are formed, a key with very many events is spread over its slices, and any number of events at one
    time is one row.
    """
    relevant = events.filter(F.col("status").isin("submitted", *TERMINAL_TASK_STATUSES))

    def earliest(word: str) -> Column:
        return F.min(F.when(F.col("status") == word, F.col("event_id"))).alias(f"_{word}")

    words = TERMINAL_TASK_STATUSES
    times = relevant.groupBy(key, "ts").agg(*[earliest(word) for word in words])
    ids = F.least(*[F.col(f"_{word}") for word in words])
    status = F.coalesce(*[F.when(F.col(f"_{word}") == ids, word) for word in words])
    mark = F.when(ids.isNotNull(), F.struct("ts", status.alias("status"))).alias("_mark")
    times = times.select(key, "ts", F.floor(F.unix_micros("ts") / (slice_sec * MICROS)).alias("_slice"), mark)

    # Both windows run backwards in time: a frame that grows is kept up row by row, one that shrinks is recomputed.
    first = latest_per_key(times.filter(F.col("_mark").isNotNull()), [F.asc("ts")], [key, "_slice"])
    slices = times.select(key, "_slice").distinct().join(first.select(key, "_slice", "_mark"), [key, "_slice"], "left")
    after = Window.partitionBy(key).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    later = slices.select(key, "_slice", F.last("_mark", ignorenulls=True).over(after).alias("_later"))
    own = Window.partitionBy(key, "_slice").orderBy(F.desc("ts")).rowsBetween(Window.unboundedPreceding, 0)
    marked = times.withColumn("_own", F.last("_mark", ignorenulls=True).over(own)).join(later, [key, "_slice"])
    nearest = F.coalesce("_own", "_later")
    in_time = nearest["ts"] < F.col("ts") + F.make_dt_interval(secs=F.lit(deadline_sec))
    outcome = marked.select(key, "ts", F.when(in_time, nearest).alias("_hit"))

    submitted = relevant.filter(F.col("status") == "submitted").select("event_id", key, "ts")
    return spread_join(submitted, outcome, [key, "ts"], "left").select(
        "event_id",
        key,
        F.col("ts").alias("submitted_at"),
        F.coalesce(F.col("_hit.status"), F.lit("timeout")).alias("status"),
        F.col("_hit.ts").alias("ended_at"),
    )


def stage_latency(events: DataFrame, stages: Sequence[str], key: str = "task_id") -> DataFrame:
    """First time of each stage per task, and the whole seconds from each stage to the next."""
    seen = events.filter(F.col("status").isin(*stages)).groupBy(key)
    firsts = seen.agg(*[F.min(F.when(F.col("status") == s, F.col("ts"))).alias(f"{s}_at") for s in stages])
    steps = [
        (F.unix_timestamp(f"{b}_at") - F.unix_timestamp(f"{a}_at")).alias(f"{a}_to_{b}_sec")
        for a, b in zip(stages, stages[1:])
    ]
    return firsts.select("*", *steps)


def succeeded(status: Column) -> Column:
    return F.coalesce(status.isin(*SUCCESS_STATUSES), F.lit(False))


def batch_progress(
    results: DataFrame, run: str = "run_id", finished: str = "finished_at", item: str = "item_id"
) -> DataFrame:
    """Per finished item: items done and failed so far, percent of the run, seconds since the run's first item."""
    failed = F.when(succeeded(F.col("status")), 0).otherwise(1)
    sums, first = {"done": F.lit(1), "failed": failed}, {"_start": F.col(finished)}
    counted = running_totals(results, [run], [finished, item], sums, first)
    return counted.select(
        *results.columns,
        "done",
        "failed",
        F.col("done_total").alias("total"),
        F.round(F.col("done") / F.col("done_total") * 100, 1).alias("percent"),
        (F.unix_timestamp(finished) - F.unix_timestamp("_start")).alias("elapsed_sec"),
    )


def batch_summary(results: DataFrame, *by: str) -> DataFrame:
    """Success, failed and total; success means embedded or indexed."""
    good = succeeded(F.col("status"))
    return results.groupBy(*by).agg(
        F.count_if(good).alias("success"), F.count_if(~good).alias("failed"), F.count(F.lit(1)).alias("total")
    )


def batch_results(inputs: DataFrame, results: DataFrame, seq: str, key: str = "s3_uri") -> DataFrame:
    """One result per input in input order (`pos`); inputs that repeat a key share its latest result."""
    latest = latest_per_key(results, [F.desc(seq)], key).drop(seq)
    return spread_join(inputs, latest, key, "left").orderBy("pos")


def requested_found(requested: DataFrame, found: DataFrame, key: str = "s3_key") -> DataFrame:
    """One row: keys asked for and keys found. Repeats count each time."""
    asked = requested.groupBy(key).agg(F.count(F.lit(1)).alias("times"))
    known = found.select(F.col(key).alias("_found")).distinct()
    joined = asked.join(known, F.col(key) == F.col("_found"), "left")
    hits = F.coalesce(F.sum(F.when(F.col("_found").isNotNull(), F.col("times"))), F.lit(0))
    return joined.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("requested"), hits.alias("found"))
