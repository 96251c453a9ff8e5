"""Quantile sketches, event-time windows, late rows over whole runs, running counts."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from mediacat.operators import reports
from mediacat.operators.tasks import batch_progress
from mediacat.streaming import windows
from mediacat.streaming.sinks import DroppedRows, counts_stream, latest_counts, running_counts

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENTS = "task_id string, status string, ts timestamp"


def run(stream, folder):
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_merged_sketches_keep_the_rank_error(spark):
    """300,000 rows in 30 parts of unlike sizes and ranges, merged: the rank of each quantile is within 0.15 % (k = 4096)."""
    rows = spark.range(300_000).select(
        F.pmod(F.xxhash64("id"), F.lit(30)).alias("part"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_000)) * (1 + F.pmod(F.col("id"), F.lit(7)))).alias("indexing_latency_sec")
    ).cache()
    sketches = reports.latency_sketches(rows.where("part < 29 or indexing_latency_sec < 1000"), "part")
    assert sketches.count() == 30
    got = reports.merged_quantiles(sketches).first()
    values = sorted(r[0] for r in rows.where("part < 29 or indexing_latency_sec < 1000").select("indexing_latency_sec").collect())
    assert got["videos"] == len(values)
    for share, name in ((0.5, "p50_sec"), (0.9, "p90_sec"), (0.99, "p99_sec")):
        below = sum(v < got[name] for v in values) / len(values)
        upto = sum(v <= got[name] for v in values) / len(values)
        assert below - 0.0015 <= share <= upto + 0.0015
    rows.unpersist()


def test_small_sketches_are_exact_and_nulls_do_not_count(spark):
    data = [("a", 5), ("a", 1), ("a", None), ("b", 9), ("c", None), ("a", 3), ("a", 3)]
    df = spark.createDataFrame(data, "source string, indexing_latency_sec long")
    exact = {tuple(r) for r in reports.latency_quantiles(df, "source").collect()}
    assert exact == {tuple(r) for r in reports.merged_quantiles(reports.latency_sketches(df, "source"), "source").collect()}
    assert reports.merged_quantiles(reports.latency_sketches(df.limit(0), "source"), "source").collect() == []


def test_sessions_end_at_the_gap(spark, folder):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice(["failed", "ready"]), START + timedelta(seconds=rng.randrange(20_000))) for _ in range(120)]
    rows += [("edge", "ready", START), ("edge", "ready", START + timedelta(seconds=600)), ("edge", "ready", START + timedelta(seconds=1201))]
    want = []
    for task in {r[0] for r in rows}:
        times = sorted((r[2], r[1]) for r in rows if r[0] == task)
        groups = [[times[0]]]
        for before, now in zip(times, times[1:]):
            if now[0] - before[0] <= timedelta(seconds=600):
                groups[-1].append(now)
            else:
                groups.append([now])
        want += [(task, g[0][0].timestamp(), len(g), sum(s == "failed" for _, s in g)) for g in groups]
    spark.createDataFrame([*rows, ("-", "alive", START + timedelta(days=2))], EVENTS).write.parquet(f"{folder}/in")
    stream = windows.task_sessions(spark.readStream.schema(EVENTS).parquet(f"{folder}/in"), "600 seconds")
    run(stream, folder)
    got = spark.read.schema(stream.schema).parquet(f"{folder}/out").where("task_id <> '-'").collect()
    assert sorted((r.task_id, r.start.timestamp(), r.events, r.failed) for r in got) == sorted(want)


def test_late_rows_of_more_batches_than_are_kept(spark, folder):
    """Twelve batches with a late row each, while Spark keeps the reports of two; a restart goes on counting."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    dropped = DroppedRows(spark, f"{folder}/dropped")
    spark.streams.addListener(dropped)
    try:
        for part in range(2):
            for n in range(6):
                at = START + timedelta(days=10 * (6 * part + n))
                rows = [("a", "ready", at), ("b", "ready", START - timedelta(days=1, seconds=6 * part + n))]
                spark.createDataFrame(rows[: 1 if part == n == 0 else 2], EVENTS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            arriving = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
            stream = windows.status_windows(arriving, "1 hour")
            query = run(stream, folder)
            assert len(query.recentProgress) <= 2
            counted = spark.read.schema(stream.schema).parquet(f"{folder}/out").where(F.col("start") < F.lit(START)).agg(F.sum("events")).first()[0] or 0
            late = dropped.total(query).first()["late"]
            assert late == 5 + 6 * part - counted and late >= 4 + 5 * part
    finally:
        spark.streams.removeListener(dropped)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert spark.read.schema(dropped.SCHEMA).parquet(f"{folder}/dropped").count() == late


def test_running_counts_end_where_the_batch_ends(spark, folder):
    rng = random.Random(2)
    rows = [(f"r{rng.randrange(3)}", i, rng.choice(["embedded", "failed", None]), START + timedelta(seconds=i)) for i in range(90)]
    schema = "run_id string, item_id long, status string, finished_at timestamp"
    items = spark.createDataFrame(rows, schema)
    planned = items.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"))
    whole = {(r.run_id, r.done): (r.failed, r.total, r.percent) for r in batch_progress(items).collect()}
    last = {}
    for part in range(3):
        items.where(f"item_id >= {30 * part} and item_id < {30 * part + 30}").write.mode("append").parquet(f"{folder}/items")
        arriving = spark.readStream.schema(schema).parquet(f"{folder}/items")
        counts_stream(running_counts(arriving, planned), f"{folder}/out", f"{folder}/c").awaitTermination()
        last = {r.run_id: r for r in latest_counts(spark, f"{folder}/out").collect()}
        assert all(whole[r.run_id, r.done] == (r.failed, r.total, r.percent) for r in last.values())  # each is a step of the run
    assert all(math.isclose(r.percent, 100.0) and r.done == r.total for r in last.values()) and len(last) == 3


def test_run_metrics_count_once_and_faults_are_told(spark, folder):
    summary = spark.createDataFrame([(3, 1)], "success long, failed long")
    for run_id in ("run-1", "a/b", "run-1", "run-1"):
        assert reports.append_run_metrics(summary, run_id, folder)
    stored = sorted((r.run_id, r.metric, r.value) for r in spark.read.parquet(folder).collect())
    assert stored == [(i, m, v) for i in ("a/b", "run-1") for m, v in (("EmbeddingsFailed", 1), ("EmbeddingsGenerated", 3))]
    with pytest.warns(UserWarning, match="run-2"):
        assert not reports.append_run_metrics(summary.drop("failed").withColumn("failed", F.raise_error(F.lit("no count")).cast("long")), "run-2", folder)
    assert spark.read.parquet(folder).count() == 4
