"""Streams: new files, manifest queue, deadlines, upserts, progress."""

import json
import os
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql.streaming.readwriter import DataStreamWriter

from mediacat.operators.tasks import task_deadline
from mediacat.plans import ingestion, stream_queries
from mediacat.sources.change_log import ChangeLog
from mediacat.sources.change_log import put as put_rows
from mediacat.streaming.deadlines import deadline_join, deadline_stream
from mediacat.streaming.ingest import stream_files, stream_manifests
from mediacat.streaming.sinks import late_rows, progress_stream, upsert_stream
from mediacat.streaming.state import partitions_for

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENTS = "event_id long, key string, status string, ts timestamp"


def put(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if age:
        os.utime(path, (time.time() - age,) * 2)


def drain(stream, folder, collect):
    query = stream.writeStream.foreachBatch(lambda df, i: collect.append([tuple(r) for r in df.collect()]))
    query = query.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def test_files_of_the_same_age_are_not_lost(spark, folder):
    batches = []
    put(f"{folder}/in/raw/a.mp4", "12", age=500)
    put(f"{folder}/in/raw/skip.txt", "1", age=500)
    stamp = os.path.getmtime(f"{folder}/in/raw/a.mp4")
    drain(stream_files(spark, f"{folder}/in", "b").select("s3_uri", "size_bytes"), folder, batches)
    put(f"{folder}/in/raw/b.mov", "123")
    os.utime(f"{folder}/in/raw/b.mov", (stamp, stamp))
    drain(stream_files(spark, f"{folder}/in", "b").select("s3_uri", "size_bytes"), folder, batches)
    assert [b for b in batches if b] == [[("s3://b/raw/a.mp4", 2)], [("s3://b/raw/b.mov", 3)]]


def test_manifest_queue_is_first_in_first_out_and_archives(spark, folder):
    batches = []
    for name, age in (("b", 300), ("a", 200), ("c", 100)):
        put(f"{folder}/pending/{name}.json", json.dumps([{"s3_key": f"{name}{i}"} for i in range(60)], indent=1), age)
    stream = stream_manifests(spark, f"{folder}/pending", f"{folder}/processed").select("s3_key")
    drain(stream, folder, batches)
    full = [b for b in batches if b]
    assert [len(b) for b in full] == [60, 60, 60]
    assert [b[0][0][0] for b in full] == ["b", "a", "c"]
    archived = [f for _, _, files in os.walk(f"{folder}/processed") for f in files if f.endswith(".json")]
    left = [f for f in os.listdir(f"{folder}/pending") if f.endswith(".json")]
    assert "b.json" in archived and sorted(archived + left) == ["a.json", "b.json", "c.json"]


def random_events(n=500, seed=2):
    rng = random.Random(seed)
    words = ["submitted", "ready", "failed", "indexing"]
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
        rows.append((i, key, rng.choice(words), START + timedelta(seconds=rng.randrange(40_000))))
    return sorted(rows, key=lambda r: r[3])


def outcomes(spark, folder, deliveries, deadline_sec=1200, lateness="10 minutes", slices=16):
    """All outcomes after each delivery, and the rows that were late."""
    seen, late = [], 0
    for rows in deliveries:
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(f"{folder}/events")
        arriving = spark.readStream.schema(EVENTS).parquet(f"{folder}/events")
        stream = deadline_stream(arriving, deadline_sec, lateness, "key", slices)
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        late += late_rows(query)
        seen.append({r.event_id: (r.status, r.ended_at) for r in spark.read.schema(stream.schema).parquet(f"{folder}/out").collect()})
    return seen, late


def alive(*hours):
    return [[(-h, "-", "alive", START + timedelta(hours=h))] for h in hours]


def test_deadline_stream_equals_batch(spark, folder):
    rows = random_events()
    deliveries = [rows[:170], rows[170:340], rows[340:], *alive(40)]
    seen, late = outcomes(spark, folder, deliveries)
    whole = {r.event_id: (r.status, r.ended_at) for r in task_deadline(spark.createDataFrame(rows, EVENTS), key="key").collect()}
    assert seen[-1] == whole and late == 0
    assert 0 < len(seen[2]) < len(whole) and all(early == {k: whole[k] for k in early} for early in seen)


def test_a_hot_key_makes_no_pairs(spark, folder):
    """4,000 submissions and ends of one key within the deadline: a submission meets its slice and one row for each other."""
    rows = [(i, "hot", "submitted" if i % 2 else "ready", START + timedelta(milliseconds=250 * i)) for i in range(4000)]
    spark.createDataFrame([*rows, *alive(40)[0]], EVENTS).write.parquet(f"{folder}/events")
    stream = deadline_stream(spark.readStream.schema(EVENTS).parquet(f"{folder}/events"), 1200, "10 minutes", "key")
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    got = {r.event_id: r.status for r in spark.read.schema(stream.schema).parquet(f"{folder}/out").collect()}
    assert got == {i: "ready" if i < 3999 else "timeout" for i in range(1, 4000, 2)}
    state = max(op["numRowsTotal"] for report in query.recentProgress for op in report["stateOperators"])
    assert state < 20_000  # rows of the input and of the slices, not their pairs (2,000 x 2,000)


def test_state_is_dealt_by_the_root_of_the_rows(spark, folder):
    """What tasks report of the state grows with the square of its partitions, so these grow with the root of the rows."""
    assert [partitions_for(n, 10_000) for n in (0, 8192, 8193, 600_000, 6_000_000, 36_000_000)] == [1, 1, 2, 9, 28, 67]
    assert partitions_for(36_000_000, 12) == 12
    rows = random_events()
    spark.createDataFrame([*rows, *alive(40)[0]], EVENTS).write.parquet(f"{folder}/events")
    stream = deadline_stream(spark.readStream.schema(EVENTS).parquet(f"{folder}/events"), 1200, "10 minutes", "key")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    started = []
    start = DataStreamWriter.start

    def noted(self, *args, **options):
        started.append(start(self, *args, **options))
        return started[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DataStreamWriter, "start", noted)
        got = stream_queries._to_parquet(stream, folder, 9000)
    whole = {r.event_id: r.status for r in task_deadline(spark.createDataFrame(rows, EVENTS), key="key").collect()}
    assert {r.event_id: r.status for r in got.collect()} == whole
    assert {op["numShufflePartitions"] for report in started[0].recentProgress for op in report["stateOperators"]} == {2}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_late_events_are_counted_and_left_out(spark, folder):
    def at(sec):
        return START + timedelta(seconds=sec)

    first = [(1, "a", "submitted", at(0)), (2, "b", "submitted", at(995))]
    late = [(3, "a", "ready", at(50)), (4, "b", "failed", at(1000))]
    seen, dropped = outcomes(spark, folder, [first, late, *alive(40)], 100, "10 seconds")
    assert {k: s for k, (s, _) in seen[-1].items()} == {1: "timeout", 2: "failed"} and dropped >= 1


def test_deadline_join_equals_batch(spark, folder):
    rng = random.Random(8)
    log = []
    for i in range(200):
        start = START + timedelta(seconds=i * 100)
        log.append((f"t{i}", "v", "submitted", start))
        for _ in range(rng.randrange(3)):
            log.append((f"t{i}", "v", rng.choice(["ready", "failed"]), start + timedelta(seconds=rng.randrange(2400))))
    df = spark.createDataFrame(log, "task_id string, video_id string, status string, ts timestamp")
    df.write.parquet(f"{folder}/log")
    events = spark.readStream.schema(df.schema).parquet(f"{folder}/log")
    stream = deadline_join(events.filter("status = 'submitted'"), events)
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
    writer.trigger(availableNow=True).start().awaitTermination()
    got = {r.task_id: r.status for r in spark.read.schema(stream.schema).parquet(f"{folder}/out").collect()}
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(log)], "event_id long, task_id string, video_id string, status string, ts timestamp")
    whole = {r.task_id: r.status for r in task_deadline(numbered).collect()}
    assert 150 < len(got) < 200 and got == {k: whole[k] for k in got}


@pytest.fixture
def stored(spark, folder):
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(spark.createDataFrame([("a", "old", None)], "video_id string, status string, note string"))
    return table


def test_upsert_stream_survives_replay(spark, folder, stored):
    rows = [("a", "new", "n", 1), ("b", "new", "n", 2)]
    changes = spark.createDataFrame(rows, "video_id string, status string, note string, seq long")
    changes.write.parquet(f"{folder}/changes")
    for checkpoint in ("c1", "c1", "c2"):  # a restart, and a lost checkpoint that delivers everything again
        arriving = spark.readStream.schema(changes.schema).parquet(f"{folder}/changes")
        upsert_stream(arriving, stored, put_rows("seq"), f"{folder}/{checkpoint}", "w").awaitTermination()
        assert sorted((r.video_id, r.status) for r in stored.read().collect()) == [("a", "new"), ("b", "new")]
    assert len(stored._batches()) == 2  # one for each checkpoint


def test_a_new_checkpoint_loses_nothing(spark, folder, stored):
    for name, key in (("one", "b"), ("two", "c")):
        changes = spark.createDataFrame([(key, "new", "n", 1)], "video_id string, status string, note string, seq long")
        changes.write.parquet(f"{folder}/{name}")
        arriving = spark.readStream.schema(changes.schema).parquet(f"{folder}/{name}")
        upsert_stream(arriving, stored, put_rows("seq"), f"{folder}/checkpoint-{name}", "w").awaitTermination()
    assert sorted(r.video_id for r in stored.read().collect()) == ["a", "b", "c"]


def test_a_repeated_embedding_run_changes_nothing(spark, folder):
    from pyspark.sql import functions as F

    from mediacat.plans import embedding

    table = ChangeLog(spark, f"{folder}/catalog")
    rows = spark.range(6).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit("ready").alias("status"), F.lit("pending").alias("embedding_status"),
        F.timestamp_seconds("id").alias("created_at"), *(F.lit(None).cast(k).alias(n) for n, k in
        (("embedding_s3", "string"), ("embed_error", "string"), ("embed_model", "string"), ("embedded_at", "timestamp"))),
    )
    table.create(rows)
    content = rows.select("video_id")

    def seen():
        vectors = sorted(r.video_id for r in spark.read.parquet(f"{folder}/run/vectors/run=r1").collect())
        done = sorted(r.video_id for r in table.read().filter("embedding_status = 'embedded'").collect())
        return vectors, done, sorted((r.metric, r.value) for r in spark.read.parquet(f"{folder}/run/run_metrics").collect())

    for _ in range(2):
        summary = embedding.run(spark, table, content, lambda b: [[1.0]] * len(b), f"{folder}/run", "r1", "m", limit=3).first()
        assert summary["success"] == 3
        assert seen() == (["v0", "v1", "v2"], ["v0", "v1", "v2"], [("EmbeddingsFailed", 0), ("EmbeddingsGenerated", 3)])


def test_progress_passes_finished_rows_only(spark, folder):
    rows = [("a", "embedded"), ("b", "embedding"), ("c", "failed"), ("d", "timeout"), ("e", "pending")]
    items = spark.createDataFrame(rows, "video_id string, status string")
    items.write.parquet(f"{folder}/items")
    arriving = spark.readStream.schema(items.schema).parquet(f"{folder}/items")
    progress_stream(arriving, f"{folder}/out", f"{folder}/c").awaitTermination()
    assert sorted(r.video_id for r in spark.read.parquet(f"{folder}/out").collect()) == ["a", "c", "d"]


def test_ingestion_of_array_manifests(spark, folder):
    from pyspark.sql import functions as F

    def at(seconds):
        return START + timedelta(seconds=seconds)

    put(f"{folder}/pending/one.json", json.dumps([{"s3_key": "k1"}, {"s3_key": "k2"}]), age=100)
    put(f"{folder}/pending/two.json", json.dumps([{"s3_key": "k3", "presigned_url": "u"}, *({"s3_key": f"k{i}"} for i in (4, 5, 6, 7))]), age=50)
    log = [
        ("t0", None, "k1", "submitted", at(-5000)), ("t0", None, None, "failed", at(-4000)), ("t1", None, "k1", "submitted", at(0)),
        ("t1", "v1", None, "ready", at(1199)), ("t3", None, "k3", "submitted", at(0)), ("t3", None, None, "failed", at(5)),
        (None, None, "k4", "upload_failed", at(0)), ("t5", None, "k5", "submitted", at(0)), ("t5", "v5", None, "ready", at(1200)),
        ("t6", None, "k6", "submitted", at(900)), ("t6", "v6", None, "ready", at(1900)),
        ("t7", None, "k7", "submitted", at(900)),
    ]
    events = spark.createDataFrame(log, "task_id string, video_id string, s3_key string, status string, ts timestamp")
    now = F.lit(at(1500)).cast("timestamp")
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(ingestion.task_rows(spark.createDataFrame([], "s3_key string"), events, "idx", now))
    ingestion.run(spark, table, f"{folder}/pending", events, "idx", f"{folder}/c", now=now).awaitTermination()

    def rows():
        return sorted((r.video_id, r.status, r.embedding_status) for r in table.read().collect())

    decided = [
        ("no-id-k3", "failed", "skipped"), ("no-id-k4", "upload_failed", "skipped"), ("no-id-k5", "timeout", "skipped"),
        ("v1", "ready", "pending"),
    ]
    open_rows = [("no-id-k2", "pending", "skipped"), ("no-id-k6", "indexing", "skipped"), ("no-id-k7", "indexing", "skipped")]
    assert rows() == sorted(decided + open_rows)
    assert len(table._batches()) == 2
    for _ in range(2):
        ingestion.settle(table, events, "idx", F.lit(at(5000)).cast("timestamp"))
        assert rows() == sorted(decided + [open_rows[0], ("v6", "ready", "pending"), ("no-id-k7", "timeout", "skipped")])
