"""Queries that run a stream over the given tables until all of it is read, and return what came out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mediacat.operators.validate import validate
from mediacat.plans import ingestion, views
from mediacat.plans.object_queries import _DESCRIBED, _RULES, _VIDEO_KEY
from mediacat.plans.catalog_queries import _LATEST, _REPLACED
from mediacat.plans.registry import query
from mediacat.plans.task_queries import _RESULTS, HALF_DAY, _results, deadline_sql
from mediacat.plans.views import time_text, with_views
from mediacat.schemas import OBJECT_LISTING, TASK_EVENTS
from mediacat.session import run_dir
from mediacat.sources import manifests
from mediacat.sources.change_log import ChangeLog, put
from mediacat.sources.listing_source import ObjectListing
from mediacat.streaming.deadlines import ALIVE, deadline_join, deadline_stream
from mediacat.sources.task_events import final_states, first_deliveries
from mediacat.streaming.ingest import stream_listing, stream_manifests
from mediacat.streaming import windows
from mediacat.streaming.sinks import DroppedRows, counts_stream, latest_counts, progress_stream, running_counts, upsert_stream
from mediacat.streaming.state import state_partitions

NOW = "2024-12-31 00:00:00"
LATER = "2024-12-31 01:00:00"


def _finish(stream: StreamingQuery) -> None:
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


def _in_order(rows: DataFrame, order: str, parts: int = 3) -> Iterator[DataFrame]:
    """The rows as `parts` deliveries in ascending order, as they would have arrived."""
    low, high = rows.agg(F.min(order), F.max(order)).first()
    step = (high - low) / parts
    for part in range(parts):
        inside = F.col(order) >= F.lit(low + part * step)
        if part < parts - 1:
            inside = inside & (F.col(order) < F.lit(low + (part + 1) * step))
        yield rows.filter(inside)


def _alive(events: DataFrame, days: int) -> DataFrame:
    """A sign of life some days after the last event, as an idle queue sends it: the watermark goes on."""
    last = events.agg((F.max("ts") + F.make_dt_interval(days=F.lit(days))).alias("ts"))
    values = {"status": F.lit(ALIVE), "ts": F.col("ts")}
    return last.select(*(values.get(c, F.lit(-1)).cast(events.schema[c].dataType).alias(c) for c in events.columns))


def _to_parquet(stream: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
    """rows: of all deliveries, where the stream keeps state."""
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    with state_partitions(stream.sparkSession, rows):
        started = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    _finish(started)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


@query("T1", "S3", "T6", sql=with_views(f"SELECT {_DESCRIBED} FROM objects WHERE {_VIDEO_KEY}", "objects"))
def stream_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of a listing that grows: one run over the first part, a second one over what is new since."""
    folder = run_dir(spark, "objects")
    listing = views.objects(spark, sf_dir).select(*OBJECT_LISTING.names)
    videos = F.col("s3_key").endswith(".mp4")
    for part in (listing.filter(videos), listing.filter(~videos)):
        part.write.mode("append").parquet(f"{folder}/listing")
        found = _to_parquet(stream_listing(spark, f"{folder}/listing"), folder)
    return found.withColumn("last_modified", time_text("last_modified"))


@query(
    "T1", "S2",
    sql="""SELECT 'source=' || source || '/delivery=' || (doc_id % 2 + 1) || '/lang=' || lang AS folder, true AS filled
        FROM documents GROUP BY ALL""",
)
def stream_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects below many prefixes as they come: a first delivery is listed, the stream stops, and goes on behind the last keys."""
    folder = run_dir(spark, "prefixes")
    spark.dataSource.register(ObjectListing)
    docs = views.table(spark, sf_dir, "documents").select("source", (F.col("doc_id") % 2 + 1).alias("delivery"), "lang", "text")
    for delivery in (1, 2):
        docs.filter(F.col("delivery") == delivery).write.mode("append").partitionBy("source", "delivery", "lang").parquet(f"{folder}/raw")
        arriving = spark.readStream.format("object_listing").options(root=f"{folder}/raw", bucket="raw").load()
        found = _to_parquet(arriving, folder)
    inside = F.regexp_extract("s3_key", r"^(.*)/[^/]*$", 1).alias("folder")
    return found.groupBy(inside).agg((F.sum("size_bytes") > 0).alias("filled"))


@query(
    "T2", "K7", "K9", "Q6",
    sql=with_views(
        "SELECT s3_key, trim(video_id) AS video_id, status, size_bytes FROM checked WHERE len(errors) = 0",
        "objects",
        ctes=_RULES,
    ),
)
def manifest_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest per index is queued and all are worked off, one per batch; what is done moves to the archive."""
    folder = run_dir(spark, "queue")
    valid, _ = validate(views.objects(spark, sf_dir), now=F.lit(NOW).cast("timestamp"))
    for index in range(4):
        queued = valid.filter(F.col("index_id") == f"idx_{index}").drop("size_corrected")
        manifests.write_manifest(queued, f"{folder}/pending", f"run-{index}")
    stream = stream_manifests(spark, f"{folder}/pending/*", f"{folder}/processed", array_files=False)
    return _to_parquet(stream.select("s3_key", "video_id", "status", "size_bytes"), folder)


@query(
    "K9", "T2",
    sql=with_views("SELECT s3_key, trim(video_id) AS video_id, size_bytes FROM checked WHERE len(errors) = 0", "objects", ctes=_RULES),
)
def archived_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the archive after a manifest per index and one more are worked off: all but the last, which no batch follows."""
    folder = run_dir(spark, "archive")
    valid, _ = validate(views.objects(spark, sf_dir), now=F.lit(NOW).cast("timestamp"))
    records = valid.drop("size_corrected")
    for index in range(4):
        manifests.write_manifest(records.filter(F.col("index_id") == f"idx_{index}"), f"{folder}/pending", f"run-{index}")
    manifests.write_manifest(records.orderBy("s3_key").limit(1), f"{folder}/pending", "run-last")
    _to_parquet(stream_manifests(spark, f"{folder}/pending/*", f"{folder}/processed", array_files=False), folder)
    archived = spark.read.schema(manifests.MANIFEST).option("recursiveFileLookup", True).json(f"{folder}/processed")
    return archived.select("s3_key", "video_id", "size_bytes")


@query("T3", "J2", "T6", sql=deadline_sql(HALF_DAY))
def stream_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of submissions while events arrive in three deliveries and a sign of life; users submit again and again."""
    folder = run_dir(spark, "deadline")
    events = views.task_events(spark, sf_dir).select("event_id", "user_id", "status", "ts")
    rows = events.count()
    for delivery in (*_in_order(events, "ts"), _alive(events, 2)):
        delivery.write.mode("append").parquet(f"{folder}/events")
        arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        outcome = _to_parquet(deadline_stream(arriving, HALF_DAY, "10 minutes", "user_id"), folder, rows)
    return outcome.withColumns({c: time_text(c) for c in ("submitted_at", "ended_at")})


@query(
    "T3",
    sql=with_views(
        """SELECT s3_key AS task_id, created_at AS submitted_at,
        CASE WHEN latency >= 0 AND latency < 1200 THEN 'ready' ELSE 'timeout' END AS status,
        CASE WHEN latency >= 0 AND latency < 1200 THEN indexed_at END AS ended_at
        FROM (SELECT *, epoch(try_cast(indexed_at AS TIMESTAMP)) - epoch(created_at::TIMESTAMP) AS latency FROM raw_metadata)
        WHERE created_at::TIMESTAMP + to_seconds(1200) < (SELECT least(max(created_at::TIMESTAMP),
            max(try_cast(indexed_at AS TIMESTAMP)) FILTER (status = 'ready')) - to_seconds(600) FROM raw_metadata)""",
        "raw_metadata",
    ),
)
def stream_deadline_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexing tasks with one submission each, joined with their ends; tasks that the watermark has not passed stay open."""
    folder = run_dir(spark, "tasks")
    raw = views.raw_metadata(spark, sf_dir)
    stamp = F.try_to_timestamp("indexed_at")
    start = raw.select(F.col("s3_key").alias("task_id"), F.lit("submitted").alias("status"), F.col("created_at").cast("timestamp").alias("ts"))
    end = raw.filter((F.col("status") == "ready") & stamp.isNotNull()).select(F.col("s3_key").alias("task_id"), "status", stamp.alias("ts"))
    log = start.unionByName(end).withColumn("video_id", F.lit(None).cast("string"))
    log.select(*TASK_EVENTS.names).write.parquet(f"{folder}/log")
    rows = spark.read.schema(TASK_EVENTS).parquet(f"{folder}/log").count()
    events = spark.readStream.schema(TASK_EVENTS).parquet(f"{folder}/log")
    outcome = _to_parquet(deadline_join(events.filter(F.col("status") == "submitted"), events), folder, rows)
    return outcome.withColumns({c: time_text(c) for c in ("submitted_at", "ended_at")})


@query(
    "T6",
    sql=with_views(
        """SELECT count(*) FILTER (NOT late) AS kept, count(*) FILTER (late) AS late FROM (SELECT event_id % 2 = 1 AND
            ts <= (SELECT date_trunc('milliseconds', max(ts)) FROM task_events WHERE event_id % 2 = 0) - to_hours(12) AS late
            FROM task_events)""",
        "task_events",
    ),
)
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events come after the other half; those behind its watermark are left out and counted."""
    folder = run_dir(spark, "late")
    events = views.task_events(spark, sf_dir).select("event_id", "ts", "status")
    rows = events.count()
    dropped = DroppedRows(spark, f"{folder}/dropped")
    spark.streams.addListener(dropped)
    for odd in (0, 1):
        events.filter(F.col("event_id") % 2 == odd).write.mode("append").parquet(f"{folder}/events")
        arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events").withWatermark("ts", "12 hours")
        writer = arriving.dropDuplicates(["event_id", "ts"]).writeStream.format("parquet").option("path", f"{folder}/out")
        with state_partitions(spark, rows):
            stream = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        _finish(stream)
    late = dropped.total(stream)
    spark.streams.removeListener(dropped)
    kept = spark.read.schema(events.schema).parquet(f"{folder}/out").agg(F.count(F.lit(1)).alias("kept"))
    return kept.withColumn("late", F.lit(late.first()["late"]).cast("long"))


@query("T4", "K2", "S8", sql=with_views(_REPLACED, "catalog", "updates", ctes=_LATEST))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates arriving in two deliveries are put into the stored catalogue."""
    folder = run_dir(spark, "upsert")
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(views.catalog(spark, sf_dir).withColumn("updated_at", F.lit(None).cast("timestamp")))
    changes = views.updates(spark, sf_dir)
    for delivery in _in_order(changes, "seq", parts=2):
        delivery.write.mode("append").parquet(f"{folder}/changes")
        arriving = spark.readStream.schema(changes.schema).parquet(f"{folder}/changes")
        _finish(upsert_stream(arriving, table, put("seq"), f"{folder}/checkpoint", "updates"))
    current = table.read()
    return current.withColumns({c: time_text(c) for c in ("created_at", "updated_at")})


@query(
    "S9", "T6",
    sql=with_views(
        """SELECT user_id::VARCHAR AS task_id, arg_min(status, ts) AS status, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ended_at, count(*) AS events
        FROM task_events WHERE status IN ('ready', 'failed') GROUP BY user_id""",
        "task_events",
    ),
)
def stream_task_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task events of which every other one is delivered twice; then the final row of each task."""
    folder = run_dir(spark, "states")
    events = views.task_events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("task_id"), F.concat(F.lit("v"), "user_id").alias("video_id"), "status", "ts", "event_id"
    )
    rows = events.count()
    for delivery in _in_order(events, "ts"):
        again = delivery.filter(F.col("event_id") % 2 == 0)
        delivery.unionByName(again).drop("event_id").write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(TASK_EVENTS).parquet(f"{folder}/in")
        log = _to_parquet(first_deliveries(arriving, "1 hour"), folder, rows)
    return final_states(log).drop("video_id").withColumn("ended_at", time_text("ended_at"))


def _windowed(spark: SparkSession, sf_dir: str, label: str, over: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """What a windowed stream gives of all task events, in two deliveries and a sign of life."""
    folder = run_dir(spark, label)
    events = views.task_events(spark, sf_dir).select(F.col("user_id").alias(key), "status", "ts")
    rows = events.count()
    for delivery in (*_in_order(events, "ts", parts=2), _alive(events, 2)):
        delivery.write.mode("append").parquet(f"{folder}/events")
        arriving = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        found = _to_parquet(over(arriving), folder, rows)
    return found


@query(
    "A8", "T6",
    sql=with_views(
        """SELECT strftime(time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS start, status, count(*) AS events
        FROM task_events GROUP BY ALL""",
        "task_events",
    ),
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per status in tumbling windows of six hours."""
    found = _windowed(spark, sf_dir, "windows", lambda e: windows.status_windows(e, "6 hours"), "task_id")
    return found.filter(F.col("status") != ALIVE).select(time_text("start").alias("start"), "status", "events")


@query(
    "A8", "T6",
    sql=with_views(
        """SELECT task_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events, count(*) FILTER (status = 'failed') AS failed FROM (
            SELECT *, sum(opens) OVER (PARTITION BY task_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS island FROM (
                SELECT user_id AS task_id, status, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 12 HOURS
                    THEN 0 ELSE 1 END AS opens FROM task_events))
        GROUP BY task_id, island""",
        "task_events",
    ),
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user's tasks: events with at most twelve hours between them."""
    found = _windowed(spark, sf_dir, "sessions", lambda e: windows.task_sessions(e, "12 hours"), "task_id")
    return found.filter(F.col("task_id") != -1).select("task_id", time_text("start").alias("start"), "events", "failed")


@query(
    "T5", "A4",
    sql=f"""WITH {_RESULTS} SELECT run_id, count(*) AS done, count(*) FILTER (status <> 'embedded') AS failed, count(*) AS total, 100.0::DOUBLE AS percent
        FROM results GROUP BY run_id""",
)
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts of each run while its items arrive in three deliveries; the last row of each run."""
    folder = run_dir(spark, "counts")
    items = _results(spark, sf_dir).select("run_id", "item_id", "status", "finished_at")
    rows = items.count()
    planned = items.groupBy("run_id").agg(F.count(F.lit(1)).alias("total"))
    for delivery in _in_order(items, "finished_at"):
        delivery.write.mode("append").parquet(f"{folder}/items")
        arriving = spark.readStream.schema(items.schema).parquet(f"{folder}/items")
        with state_partitions(spark, rows):
            started = counts_stream(running_counts(arriving, planned), f"{folder}/out", f"{folder}/checkpoint")
        _finish(started)
    return latest_counts(spark, f"{folder}/out")


@query("T5", sql=f"WITH {_RESULTS} SELECT run_id, item_id, status FROM results WHERE status <> 'embedding'")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished items, passed on as they come."""
    folder = run_dir(spark, "progress")
    items = _results(spark, sf_dir).select("run_id", "item_id", "status")
    items.write.parquet(f"{folder}/items")
    arriving = spark.readStream.schema(items.schema).parquet(f"{folder}/items")
    _finish(progress_stream(arriving, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.schema(items.schema).parquet(f"{folder}/out")


_INGESTED = """ingested AS (SELECT o.*, quality, CASE WHEN doc_id % 13 = 0 THEN 'pending' WHEN doc_id % 17 = 0 THEN 'upload_failed'
        WHEN quality IS NOT NULL AND doc_id % 5 <> 2 THEN CASE WHEN quality = 1 THEN 'ready' ELSE 'failed' END
        WHEN quality IS NULL AND doc_id % 3 = 0 AND doc_id % 2 = 0 THEN 'ready' ELSE 'timeout' END AS outcome,
    quality IS NULL AND doc_id % 3 = 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 AS later
    FROM checked o LEFT JOIN labels USING (doc_id) WHERE len(errors) = 0)"""


@query(
    "T2", "J1", "J2", "K5", "T4", "S6",
    sql=with_views(
        f"""SELECT CASE WHEN outcome IN ('ready', 'failed') THEN 's' || doc_id ELSE 'no-id-' || s3_key END AS video_id, s3_key,
        'idx_9' AS index_id, outcome AS status, CASE WHEN outcome NOT IN ('pending', 'upload_failed') THEN 't' || doc_id END AS task_id,
        CASE WHEN later THEN '{LATER}' ELSE '{NOW}' END AS indexed_at,
        CASE WHEN outcome = 'ready' THEN 'pending' ELSE 'skipped' END AS embedding_status FROM ingested""",
        "objects",
        ctes=f"{_RULES}, {_INGESTED}",
    ),
)
def ingestion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queued objects get the outcome of their latest submission; a second look an hour later settles what was undecided.

    By document number: every 13th object is never submitted, every 17th upload fails, one in seven had an earlier task that
    failed, one in five tasks ends at its deadline. Unlabelled ones end late or never, one in three after the first look.
    """
    folder = run_dir(spark, "ingestion")
    now, later = F.lit(NOW).cast("timestamp"), F.lit(LATER).cast("timestamp")
    valid, _ = validate(views.objects(spark, sf_dir), now=now)
    n, nothing = F.col("doc_id"), F.lit(None).cast("string")
    known = views.objects(spark, sf_dir).select("doc_id", "s3_key").filter(n % 13 != 0)
    known = known.join(views.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    waits = F.col("quality").isNull() & (n % 3 == 0)
    at = now - F.make_dt_interval(secs=F.when(waits, 600).otherwise(3600))

    def event(rows: DataFrame, prefix: str, video: Column, status: Column, ts: Column) -> DataFrame:
        task = F.when(status != F.lit("upload_failed"), F.concat(F.lit(prefix), n.cast("string")))
        return rows.select(task.alias("task_id"), video.alias("video_id"), "s3_key", status.alias("status"), ts.alias("ts"))

    def after(seconds: Column | int) -> Column:
        return at + F.make_dt_interval(secs=F.lit(seconds) if isinstance(seconds, int) else seconds)

    video = F.concat(F.lit("s"), n.cast("string"))
    again = known.filter(n % 7 == 1)
    ended = known.filter(F.col("quality").isNotNull() & (n % 17 != 0))
    word = F.when(F.col("quality") == 1, "ready").otherwise("failed")
    log = event(known, "t", nothing, F.when(n % 17 == 0, "upload_failed").otherwise("submitted"), at)
    log = log.unionByName(event(again, "a", nothing, F.lit("submitted"), after(-3600)))
    log = log.unionByName(event(again, "a", nothing, F.lit("failed"), after(-3500)))
    log = log.unionByName(event(ended, "t", video, word, after(F.when(n % 5 == 2, 1200).otherwise(600))))
    log = log.unionByName(event(known.filter(waits & (n % 17 != 0) & (n % 2 == 0)), "t", video, F.lit("ready"), after(900)))
    log.write.parquet(f"{folder}/log")  # the log is a stored table, which every batch reads
    log = spark.read.schema(log.schema).parquet(f"{folder}/log")
    for index in ("idx_0", "idx_1", "idx_2", "idx_3"):
        queued = valid.filter(F.col("index_id") == index).drop("size_corrected")
        manifests.write_manifest(queued, f"{folder}/pending", index)
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(ingestion.task_rows(valid.limit(0), log, "idx_9", now))
    _finish(ingestion.run(spark, table, f"{folder}/pending/*", log, "idx_9", f"{folder}/checkpoint", now=now, array_files=False))
    ingestion.settle(table, log, "idx_9", later)
    return table.read().withColumn("indexed_at", time_text("indexed_at"))
