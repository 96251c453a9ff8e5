"""The embedding run: pick waiting videos, embed them, store vectors, update the catalogue, count."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.operators.embed import BatchFunction, embed
from mediacat.operators.reports import append_run_metrics
from mediacat.sources.change_log import ChangeLog, set_columns
from mediacat.sources.vectors import write_vectors


def _once(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What is stored at `path`, or else what `make` gives, stored there first. Files of a job that died are replaced."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing there, or no finished files
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def run(
    spark: SparkSession,
    table: ChangeLog,
    content: DataFrame,
    fn: BatchFunction,
    folder: str,
    run_id: str,
    model: str,
    now: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Embed the oldest `limit` waiting videos (None: all) whose input rows are in `content` by `video_id`; returns the summary.

    A run can be repeated under its id: the videos that it picked and the model's output are stored before anything follows from
    them and are used again, so its vectors, catalogue changes and metrics are the same and count once.
    """
    now = F.current_timestamp() if now is None else now
    picked = _once(spark, f"{folder}/picked/run={run_id}", lambda: oc.pending_embedding(table.read(), limit).select(oc.KEY))
    stored = _once(spark, f"{folder}/model_output/run={run_id}", lambda: embed(content.join(picked, oc.KEY, "left_semi"), fn, (oc.KEY,)))
    write_vectors(stored, f"{folder}/vectors/run={run_id}", model, mode="overwrite")
    results = oc.embedding_result_rows(stored, model)
    changes, sets = oc.embedding_changes(results, now)
    table.apply(changes, set_columns("_seq", sets), f"embedding:{run_id}")  # a repeated run writes its batch again
    summary = oc.embedding_summary(results)
    append_run_metrics(summary, run_id, f"{folder}/run_metrics")
    return summary
