"""Queries over task events and batch results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.operators import tasks
from mediacat.plans import views
from mediacat.plans.registry import query
from mediacat.plans.views import time_text, with_views
from mediacat.session import run_dir
from mediacat.sources.task_events import append_task_events, read_task_events

_T = "'%Y-%m-%d %H:%M:%S'"
HALF_DAY = 12 * 3600


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.task_events(spark, sf_dir)


_TERMINAL = "ended AS (SELECT * FROM task_events WHERE status IN ('ready', 'failed'))"


@query(
    "J1",
    sql=with_views(
        f"""SELECT event_id, user_id, coalesce(f.status, 'pending') AS status, strftime(f.ended_at, {_T}) AS ended_at
        FROM (SELECT event_id, user_id FROM task_events WHERE status = 'submitted') s LEFT JOIN
        (SELECT user_id, arg_min(status, ts) AS status, min(ts) AS ended_at FROM ended GROUP BY user_id) f USING (user_id)""",
        "task_events",
        ctes=_TERMINAL,
    ),
)
def task_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    submitted = events.filter(F.col("status") == "submitted").select("event_id", "user_id")
    return tasks.task_status(submitted, events, "user_id").withColumn("ended_at", time_text("ended_at"))


def deadline_sql(deadline_sec: int) -> str:
    """Each submission with the first final event of its user before the deadline."""
    return with_views(
        f"""SELECT s.event_id, s.user_id, strftime(s.ts, {_T}) AS submitted_at,
        coalesce(arg_min(e.status, e.ts), 'timeout') AS status, strftime(min(e.ts), {_T}) AS ended_at
        FROM task_events s LEFT JOIN ended e ON e.user_id = s.user_id AND e.ts >= s.ts
            AND e.ts < s.ts + to_seconds({deadline_sec})
        WHERE s.status = 'submitted' GROUP BY s.event_id, s.user_id, s.ts""",
        "task_events",
        ctes=_TERMINAL,
    )


def _shown(outcome: DataFrame) -> DataFrame:
    return outcome.withColumns({c: time_text(c) for c in ("submitted_at", "ended_at")})


@query("J2", sql=deadline_sql(HALF_DAY))
def task_deadline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(tasks.task_deadline(_events(spark, sf_dir), HALF_DAY, "user_id"))


@query("J2", sql=deadline_sql(1200))
def task_deadline_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(tasks.task_deadline(_events(spark, sf_dir), key="user_id"))


@query(
    "A9",
    sql=with_views(
        f"""SELECT user_id, {', '.join(f"strftime({s}, {_T}) AS {s}_at" for s in ('submitted', 'indexing', 'ready'))},
        epoch(date_trunc('second', indexing))::BIGINT - epoch(date_trunc('second', submitted))::BIGINT AS submitted_to_indexing_sec,
        epoch(date_trunc('second', ready))::BIGINT - epoch(date_trunc('second', indexing))::BIGINT AS indexing_to_ready_sec
        FROM (SELECT user_id, min(ts) FILTER (status = 'submitted') AS submitted,
            min(ts) FILTER (status = 'indexing') AS indexing, min(ts) FILTER (status = 'ready') AS ready
            FROM task_events WHERE status IN ('submitted', 'indexing', 'ready') GROUP BY user_id)""",
        "task_events",
    ),
)
def stage_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = ("submitted", "indexing", "ready")
    rows = tasks.stage_latency(_events(spark, sf_dir), stages, "user_id")
    return rows.withColumns({f"{s}_at": time_text(f"{s}_at") for s in stages})


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as finished items of one batch per priority."""
    return views.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run_id"),
        F.col("o_orderkey").alias("item_id"),
        F.col("o_orderdate").cast("timestamp").alias("finished_at"),
        F.when(F.col("o_orderstatus") == "F", "embedded").when(F.col("o_orderstatus") == "O", "embedding").otherwise("failed").alias("status"),
    )


_RESULTS = """results AS (SELECT o_orderpriority AS run_id, o_orderkey AS item_id, o_orderdate AS finished_at,
    CASE o_orderstatus WHEN 'F' THEN 'embedded' WHEN 'O' THEN 'embedding' ELSE 'failed' END AS status FROM orders)"""


@query(
    "A4",
    sql=f"""WITH {_RESULTS} SELECT run_id, item_id, status, strftime(finished_at, {_T}) AS finished_at,
        row_number() OVER w AS done, (sum(CASE WHEN status = 'embedded' THEN 0 ELSE 1 END) OVER w)::BIGINT AS failed,
        count(*) OVER r AS total, round(row_number() OVER w / count(*) OVER r * 100, 1) AS percent,
        epoch(finished_at)::BIGINT - epoch(min(finished_at) OVER r)::BIGINT AS elapsed_sec FROM results
        WINDOW w AS (PARTITION BY run_id ORDER BY finished_at, item_id ROWS UNBOUNDED PRECEDING),
        r AS (PARTITION BY run_id)""",
)
def batch_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    progress = tasks.batch_progress(_results(spark, sf_dir))
    return progress.withColumn("finished_at", time_text("finished_at"))


@query(
    "A3",
    sql=f"""WITH {_RESULTS} SELECT run_id, count(*) FILTER (status = 'embedded') AS success,
        count(*) FILTER (status <> 'embedded') AS failed, count(*) AS total FROM results GROUP BY run_id""",
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.batch_summary(_results(spark, sf_dir), "run_id")


@query(
    "J6", "Q7",
    sql="""SELECT c_custkey AS pos, 's3://raw/' || c_mktsegment || '/' || c_nationkey AS s3_uri,
        arg_max(o_orderstatus, o_orderkey) AS status
        FROM customer LEFT JOIN (SELECT o_orderkey, o_orderstatus, c_mktsegment AS segment, c_nationkey AS nation
            FROM orders JOIN customer ON o_custkey = c_custkey) o ON segment = c_mktsegment AND nation = c_nationkey
        GROUP BY c_custkey, c_mktsegment, c_nationkey""",
)
def batch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as inputs, many of which share an address; the orders of an address are its results."""
    customers = views.table(spark, sf_dir, "customer")
    uri = F.concat(F.lit("s3://raw/"), "c_mktsegment", F.lit("/"), F.col("c_nationkey").cast("string")).alias("s3_uri")
    orders = views.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    results = orders.select(uri, F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("seq"))
    return tasks.batch_results(customers.select(F.col("c_custkey").alias("pos"), uri), results, "seq")


@query(
    "S9",
    sql=with_views(
        f"""SELECT 't' || event_id AS task_id, 'v' || user_id AS video_id, status, strftime(ts, {_T}) AS ts
        FROM task_events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'""",
        "task_events",
    ),
)
def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to the task log and read back from a day on."""
    folder = run_dir(spark, "tasks")
    events = _events(spark, sf_dir).select(
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("task_id"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("video_id"),
        "status",
        "ts",
    )
    append_task_events(events, folder)
    return read_task_events(spark, folder, since="2024-01-10").withColumn("ts", time_text("ts"))
