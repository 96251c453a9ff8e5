"""The ingestion run: take queued manifests in order, look up their tasks, write the outcome to the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mediacat.operators import catalog as oc
from mediacat.operators.tasks import submission_outcome
from mediacat.schemas import INDEX_DEADLINE_SEC, OPEN_TASK_STATUSES
from mediacat.sources.change_log import ChangeLog, put
from mediacat.streaming.ingest import stream_manifests
from mediacat.streaming.sinks import upsert_stream


def task_rows(
    manifest: DataFrame, events: DataFrame, index_id: str, now: Column, deadline_sec: int = INDEX_DEADLINE_SEC
) -> DataFrame:
    """Catalogue rows for manifest records by `s3_key`: what became of the key's latest submission, as of `now`.

    Undecided records are rows too, with status `indexing` or `pending`; `settle` looks at them again.
    """
    return oc.task_result_rows(submission_outcome(manifest, events, "s3_key", now, deadline_sec), index_id, now)


def _numbered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_seq", F.coalesce("task_id", F.lit("")))


def settle(
    table: ChangeLog, events: DataFrame, index_id: str, now: Column | None = None, deadline_sec: int = INDEX_DEADLINE_SEC
) -> int:
    """Look again at the undecided records of an index and store those that are decided by now; repeating it changes nothing.

    A record that gets its video's id leaves the row under its stand-in id.
    """
    now = F.current_timestamp() if now is None else now
    waiting = table.read().filter(F.col("status").isin(*OPEN_TASK_STATUSES) & (F.col("index_id") == index_id))
    waiting = waiting.select("s3_key", F.col(oc.KEY).alias("_old"))
    rows = task_rows(waiting, events, index_id, now, deadline_sec).filter(~F.col("status").isin(*OPEN_TASK_STATUSES))
    decided = _numbered(rows).join(waiting, "s3_key").withColumn("_gone", F.lit(False))
    left = decided.filter(F.col("_old") != F.col(oc.KEY)).withColumns({oc.KEY: F.col("_old"), "_gone": F.lit(True)})
    return table.apply(decided.unionByName(left).drop("_old"), put("_seq", gone="_gone"))


def run(
    spark: SparkSession,
    table: ChangeLog,
    queue: str,
    events: DataFrame,
    index_id: str,
    checkpoint: str,
    archive: str | None = None,
    now: Column | None = None,
    array_files: bool = True,
) -> StreamingQuery:
    """Work off all manifests that lie in the queue, oldest first, one per batch; `settle` follows up what stays undecided."""
    now = F.current_timestamp() if now is None else now
    manifests = stream_manifests(spark, queue, archive, array_files)

    def prepare(manifest: DataFrame) -> DataFrame:
        return _numbered(task_rows(manifest, events, index_id, now))

    return upsert_stream(manifests, table, put("_seq"), checkpoint, "ingestion", prepare=prepare)
