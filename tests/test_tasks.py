"""Deadlines, running totals and batch results against brute force."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from mediacat.operators import tasks
from mediacat.operators.running import row_positions, running_totals

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
DDL = "event_id long, task_id string, status string, ts timestamp"


def brute_deadline(rows, deadline):
    out = {}
    for event_id, task, status, ts in rows:
        if status != "submitted":
            continue
        ends = [r for r in rows if r[1] == task and r[2] in ("ready", "failed") and ts <= r[3] < ts + timedelta(seconds=deadline)]
        out[event_id] = min(ends, key=lambda r: (r[3], r[0]))[2] if ends else "timeout"
    return out


def outcome(spark, rows, deadline, slice_sec):
    df = spark.createDataFrame(rows, DDL)
    return {r.event_id: r.status for r in tasks.task_deadline(df, deadline, slice_sec=slice_sec).collect()}


@pytest.mark.parametrize("deadline, slice_sec", [(1200, 60), (1200, 1200), (50, 7), (86400, 60)])
def test_deadline_equals_brute_force_with_a_hot_task(spark, deadline, slice_sec):
    rng = random.Random(deadline)
    words = ["submitted", "ready", "failed", "indexing"]
    rows = []
    for i in range(900):
        task = "hot" if rng.random() < 0.4 else f"t{rng.randrange(40)}"
        rows.append((i, task, rng.choice(words), START + timedelta(seconds=rng.randrange(20000) / 2)))
    assert outcome(spark, rows, deadline, slice_sec) == brute_deadline(rows, deadline)


def test_deadline_bounds(spark):
    def at(sec):
        return START + timedelta(seconds=sec)

    rows = [
        (1, "same", "submitted", at(0)), (2, "same", "ready", at(0)),
        (3, "last", "submitted", at(0)), (4, "last", "ready", at(1199.999)),
        (5, "late", "submitted", at(0)), (6, "late", "ready", at(1200)),
        (7, "early", "submitted", at(10)), (8, "early", "ready", at(9)),
        (9, "first", "submitted", at(0)), (10, "first", "failed", at(5)), (11, "first", "ready", at(6)),
    ]
    assert outcome(spark, rows, 1200, 60) == {1: "ready", 3: "ready", 5: "timeout", 7: "timeout", 9: "failed"}


def test_fixture_counts_of_the_half_day_deadline(spark):
    from mediacat.plans import views

    events = views.task_events(spark, "/root/testdata/sf0.01")
    got = tasks.task_deadline(events, 12 * 3600, "user_id").groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in got} == {"ready": 368, "failed": 342, "timeout": 1307}


def test_running_totals_with_a_hot_group(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["g1", "g2", None]), rng.randrange(50), i, rng.randrange(9)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, t int, id int, x int").repartition(16)
    sums = {"n": F.lit(1), "s": F.col("x")}
    out = running_totals(df, ["g"], ["t", "id"], sums, {"low": F.col("t")}).collect()
    expected, state = {}, {}
    for g, t, i, x in sorted(rows, key=lambda r: r[1:3]):
        n, s = state.get(g, (0, 0))
        state[g] = expected[(g, i)] = (n + 1, s + x)
    assert {(r.g, r.id): (r.n, r.s) for r in out} == expected
    assert {(r.g, r.n_total, r.s_total) for r in out} == {(g, *v) for g, v in state.items()}
    assert {(r.g, r.low) for r in out} == {(g, min(r[1] for r in rows if r[0] == g)) for g in state}


def test_hot_group_is_spread_over_ranges(spark):
    df = spark.range(100_000).select(F.lit("one").alias("g"), F.col("id"))
    with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_conf.items():
        spark.conf.set(key, value)
    try:
        cut = df.repartitionByRange("g", "id").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        for key in with_conf:
            spark.conf.unset(key)
    assert len(cut) == 8 and max(r["count"] for r in cut) < 30_000


def test_row_positions(spark):
    df = spark.range(777).select((F.lit(1000) - F.col("id")).alias("k"))
    got = {r.k: r.position for r in row_positions(df, ["k"]).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(got))}


def test_progress_of_one_run(spark):
    rows = [("r", i, START + timedelta(seconds=i // 2), s) for i, s in enumerate(["embedded", "embedding", "indexed", None])]
    df = spark.createDataFrame(rows, "run_id string, item_id long, finished_at timestamp, status string")
    got = [(r.done, r.failed, r.percent, r.elapsed_sec) for r in tasks.batch_progress(df).orderBy("item_id").collect()]
    assert got == [(1, 0, 25.0, 0), (2, 1, 50.0, 0), (3, 1, 75.0, 1), (4, 2, 100.0, 1)]
    assert tuple(tasks.batch_summary(df).first()) == (2, 2, 4)


def test_batch_results_keep_input_order_and_share_repeats(spark):
    inputs = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "none")], "pos int, s3_uri string")
    results = spark.createDataFrame([("a", "x", 1), ("b", "old", 1), ("b", "new", 2)], "s3_uri string, status string, seq int")
    rows = tasks.batch_results(inputs, results, "seq").collect()
    assert [(r.pos, r.s3_uri, r.status) for r in rows] == [(0, "b", "new"), (1, "a", "x"), (2, "b", "new"), (3, "none", None)]


def test_task_status_without_event_ids(spark):
    events = spark.createDataFrame(
        [("t1", "v1", "ready", START), ("t1", "v2", "failed", START + timedelta(1)), ("t2", None, "indexing", START)],
        "task_id string, video_id string, status string, ts timestamp",
    )
    submitted = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "task_id string")
    rows = tasks.task_status(submitted, events, extra=("video_id",)).orderBy("task_id").collect()
    assert [(r.task_id, r.status, r.video_id) for r in rows] == [("t1", "ready", "v1"), ("t2", "pending", None), ("t3", "pending", None)]
