"""A batch of videos through their whole lifecycle: index, embed, store, persist, and report in input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.functions.objects import split_uri
from mediacat.operators import catalog as oc
from mediacat.operators.embed import BatchFunction, embed
from mediacat.operators.joins import spread_join
from mediacat.operators.tasks import submission_outcome
from mediacat.schemas import INDEX_DEADLINE_SEC, OPEN_TASK_STATUSES
from mediacat.sources.change_log import ChangeLog, put
from mediacat.sources.vectors import write_vectors


METADATA = "map<string,string>"


def index_stage(inputs: DataFrame, events: DataFrame, index_id: str, now: Column) -> DataFrame:
    """One record per input URI by its latest submission: `indexed` where that is ready, `indexing` while it may still end in
    time, else `failed` with the reason. Records keep the `metadata` map of their input, of the last one where a URI repeats."""
    joined = submission_outcome(inputs, events, "s3_uri", now).withColumnRenamed("status", "task_status")
    given = inputs if "metadata" in inputs.columns else inputs.withColumn("metadata", F.lit(None).cast(METADATA))
    given = oc.latest_per_key(given, [F.desc("pos")], "s3_uri").select("s3_uri", F.col("metadata").cast(METADATA).alias("metadata"))
    joined = joined.join(given, "s3_uri")
    undecided = F.col("task_status").isin(*OPEN_TASK_STATUSES)
    error = (
        F.when(split_uri(F.col("s3_uri")).isNull(), F.concat(F.lit("not an object URI: "), "s3_uri"))
        .when(undecided, F.lit(None))
        .when(F.col("task_status") == "timeout", f"task did not complete within {INDEX_DEADLINE_SEC}s")
        .when(F.col("task_status") == "upload_failed", "upload failed")
        .when(F.col("task_status") == "failed", F.concat(F.lit("indexing failed: task "), "task_id"))
        .when(F.coalesce("video_id", F.lit("")) == "", "no video_id before embedding")
    )
    return joined.select(
        "s3_uri",
        F.lit(index_id).alias("index_id"),
        "task_id",
        "video_id",
        F.when(error.isNotNull(), "failed").when(undecided, "indexing").otherwise("indexed").alias("status"),
        error.alias("error"),
        now.alias("created_at"),
        F.when(F.col("task_status") == "ready", F.col("ended_at")).alias("indexed_at"),
        F.coalesce("metadata", F.create_map().cast(METADATA)).alias("metadata"),
    )


def embed_stage(records: DataFrame, embedded: DataFrame, now: Column) -> DataFrame:
    """Records with the model's output: `embedded`, `embedding` without a vector, or `failed` with its error."""
    output = oc.store_stage(embedded.withColumnRenamed("error", "model_error"), now)
    output = output.select(
        oc.KEY, F.col("status").alias("model_status"), "model_error", "embedding_dim", "embedding_s3", "embedded_at"
    )
    joined = spread_join(records, output, oc.KEY, "left")  # many records may have no id
    ran = (F.col("status") == "indexed") & F.col("model_status").isNotNull()
    status = F.when(ran & F.col("model_error").isNotNull(), "failed").when(ran, F.col("model_status"))
    return joined.withColumns(
        {"status": F.coalesce(status, "status"), "error": F.coalesce("error", "model_error")}
    ).drop("model_status", "model_error")


def run(
    spark: SparkSession,
    table: ChangeLog,
    inputs: DataFrame,
    events: DataFrame,
    content: DataFrame,
    fn: BatchFunction,
    folder: str,
    index_id: str,
    model: str,
    now: Column | None = None,
) -> DataFrame:
    """Process the inputs (`pos`, `s3_uri` and, if wanted, a map `metadata`) and return one record per input, in order; repeats share a record.

    `events` holds task events with `s3_uri`, `content` the model's input rows by `video_id`. Vectors and catalogue are written;
    records without an id cannot be stored and are only returned. A later run in the same folder takes the place of the earlier
    one, and decides what was still `indexing`.
    """
    now = F.current_timestamp() if now is None else now
    records = index_stage(inputs, events, index_id, now)
    wanted = records.filter(F.col("status") == "indexed").select(oc.KEY)
    output = f"{folder}/model_output"
    embed(content.join(wanted, oc.KEY, "left_semi"), fn, (oc.KEY,)).write.mode("overwrite").parquet(output)
    embedded = spark.read.parquet(output)
    write_vectors(embedded, f"{folder}/vectors", model, mode="overwrite")
    embed_stage(records, embedded, now).write.mode("overwrite").parquet(f"{folder}/records")
    final = spark.read.parquet(f"{folder}/records")
    keyed = oc.lifecycle_rows(final)[0].withColumn("_seq", F.col("s3_uri"))
    table.apply(keyed, put("_seq"))
    return spread_join(inputs.drop("metadata"), final, "s3_uri", "left").orderBy("pos")
