"""Stream ends: upserts into the catalogue, and finished results as they come."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from mediacat.operators.catalog import latest_per_key
from mediacat.operators.tasks import succeeded
from mediacat.sources.change_log import Change, ChangeLog

FINISHED = ("embedded", "indexed", "failed", "skipped", "ready", "timeout")


def upsert_stream(
    changes: DataFrame,
    table: ChangeLog,
    change: Change,
    checkpoint: str,
    writer: str,
    available_now: bool = True,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Append each micro-batch of changes to the table's log. A replay overwrites its own batch.

    Batch ids count from 0 for every new checkpoint, so batches are named by writer and by the id that the stream keeps in
    its checkpoint.

    `prepare` turns a micro-batch into changes with batch operators, such as joins with static tables.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        stream = table.spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        table.apply(prepare(batch), change, f"{writer}:{stream}", batch_id)

    query = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query).start()


def late_rows(stream: StreamingQuery) -> int:
    """Rows that a stream left out because they were behind its watermark, by its own progress reports.

    Spark keeps the last `spark.sql.streaming.numRecentProgressUpdates` reports; a stream that runs on is asked between them.
    """
    reports = stream.recentProgress
    return sum(operator["numRowsDroppedByWatermark"] for report in reports for operator in report["stateOperators"])


class DroppedRows(StreamingQueryListener):
    """Appends the rows that each batch left out as late to a table, so that the count covers a whole run.

    Add it with `spark.streams.addListener`. A restarted query goes on in the same table. The folder holds one small row per
    batch that dropped rows: (query, run, batch, dropped).
    """

    SCHEMA = "query string, run string, batch long, dropped long"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self._done: set[str] = set()
        self._ended = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        dropped = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        if dropped:
            row = self.spark.createDataFrame([(str(progress.id), str(progress.runId), progress.batchId, dropped)], self.SCHEMA)
            # a batch that is reported again takes its own folder again
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/report={progress.runId}-{progress.batchId}")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._ended:
            self._done.add(str(event.runId))
            self._ended.notify_all()

    def total(self, stream: StreamingQuery, timeout: float = 60.0) -> DataFrame:
        """One row `late`: what all runs of the stream's query dropped. Waits until the reports of a run that has ended are in."""
        with self._ended:
            if not stream.isActive and not self._ended.wait_for(lambda: str(stream.runId) in self._done, timeout):
                raise TimeoutError("the stream's last reports did not arrive")
        try:
            reports = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        except AnalysisException:  # nothing was dropped
            reports = self.spark.createDataFrame([], self.SCHEMA)
        return reports.filter(F.col("query") == str(stream.id)).agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("late"))


def finished_rows(results: DataFrame) -> DataFrame:
    """Records that have reached a final status."""
    return results.filter(F.col("status").isin(*FINISHED))


def running_counts(results: DataFrame, planned: DataFrame) -> DataFrame:
    """Stream of counts per run while it goes on, for update mode: run_id, done, failed, total, percent.

    `planned` is a static table (run_id, total). The state is one row per run; every batch gives a row for each run it touches.
    """
    failed = F.count_if(~succeeded(F.col("status")))
    counts = results.join(planned, "run_id").groupBy("run_id", "total").agg(F.count(F.lit(1)).alias("done"), failed.alias("failed"))
    return counts.select("run_id", "done", "failed", "total", F.round(F.col("done") / F.col("total") * 100, 1).alias("percent"))


def counts_stream(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write each batch of running counts to a folder of its own, which a replay overwrites; `latest_counts` reads them."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = counts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query).start()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest counts of every run."""
    return latest_per_key(spark.read.parquet(path), [F.desc("batch")], "run_id").drop("batch")


def progress_stream(
    results: DataFrame, path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append finished records to a Parquet table as they come."""
    query = finished_rows(results).writeStream.outputMode("append").format("parquet")
    query = query.option("path", path).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query).start()
