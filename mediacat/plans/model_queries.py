"""Queries over model jobs. The model itself is the user's; here small functions over whole texts stand in for it."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.operators import reports, tasks
from mediacat.operators.embed import embed, generate
from mediacat.plans import embedding, lifecycle, views
from mediacat.plans.registry import query
from mediacat.plans.views import time_text, with_views
from mediacat.session import run_dir
from mediacat.sources.change_log import ChangeLog
from mediacat.sources.vectors import decode_vectors as vectors_of
from mediacat.sources.vectors import read_vector_table, write_vectors

NOW = "2024-12-31 00:00:00"
LETTERS = "aeiou"
MIN_CHARS = 100


def count_letters(rows: pd.DataFrame) -> list[list[int]]:
    """One count per vowel over the whole text; short texts are refused, texts without vowels have no vector."""
    vectors = []
    for text in rows["text"]:
        if len(text) < MIN_CHARS:
            raise ValueError(f"text of {len(text)} characters is too short")
        counts = [text.count(letter) for letter in LETTERS]
        vectors.append(counts if any(counts) else [])
    return vectors


def count_words(rows: pd.DataFrame, kind: str, prompt: str | None) -> list[str]:
    return [f"{prompt or kind}: {text.count(' ') + 1} words" for text in rows["text"]]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.table(spark, sf_dir, "documents")
    return documents.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("video_id"), "text")


_COUNTS = [f"(length(text) - length(replace(text, '{letter}', '')))" for letter in LETTERS]

_EMBEDDED = f"""embedded AS (SELECT 'd' || doc_id AS video_id,
    CASE WHEN length(text) >= {MIN_CHARS} THEN CASE WHEN {' + '.join(_COUNTS)} = 0 THEN '' ELSE
    concat_ws(',', {', '.join(_COUNTS)}) END END AS vector,
    CASE WHEN length(text) < {MIN_CHARS} THEN 'text of ' || length(text) || ' characters is too short' END AS error
    FROM documents)"""


def _vector_text() -> object:
    return F.array_join(F.transform("embedding", lambda x: x.cast("int").cast("string")), ",")


@query("V7", sql=f"WITH {_EMBEDDED} SELECT * FROM embedded")
def embed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    embedded = embed(_texts(spark, sf_dir), count_letters)
    return embedded.select("video_id", _vector_text().alias("vector"), "error")


@query(
    "V8",
    sql=f"""WITH {_EMBEDDED} SELECT video_id, CASE WHEN coalesce(vector, '') <> '' THEN 'embedded' ELSE 'embedding' END
        AS status, CASE WHEN coalesce(vector, '') <> '' THEN 5 ELSE 0 END AS embedding_dim,
        CASE WHEN coalesce(vector, '') <> '' THEN 'embeddings/' || video_id || '.npy' END AS embedding_s3,
        CASE WHEN coalesce(vector, '') <> '' THEN '{NOW}' END AS embedded_at FROM embedded""",
)
def store_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a vector stay `embedding`."""
    embedded = embed(_texts(spark, sf_dir), count_letters)
    staged = oc.store_stage(embedded, F.lit(NOW).cast("timestamp"))
    shown = staged.select("video_id", "status", "embedding_dim", "embedding_s3", "embedded_at")
    return shown.withColumn("embedded_at", time_text("embedded_at"))


@query(
    "K8", "V7",
    sql=f"""WITH {_EMBEDDED} SELECT video_id, vector, 5 AS vector_dim, 'embeddings/' || video_id || '.npy' AS embedding_s3,
        'letters' AS embed_model FROM embedded WHERE coalesce(vector, '') <> ''""",
)
def write_vector_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written by model and read back."""
    folder = run_dir(spark, "vectors")
    write_vectors(embed(_texts(spark, sf_dir), count_letters), folder, "letters")
    stored = read_vector_table(spark, folder, "letters")
    return stored.select("video_id", _vector_text().alias("vector"), "vector_dim", "embedding_s3", "embed_model")


@query(
    "V10",
    sql="""SELECT 'd' || doc_id AS video_id, 'chapter: ' || (length(text) - length(replace(text, ' ', '')) + 1) || ' words'
        AS text, NULL::VARCHAR AS error FROM documents""",
)
def generate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate(_texts(spark, sf_dir), count_words, "chapter")


def _as_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        contents = []
        for vector in batch["embedding"]:
            file = io.BytesIO()
            np.save(file, np.asarray(vector, np.float32), allow_pickle=False)
            contents.append(file.getvalue())
        yield pd.DataFrame({"video_id": batch["video_id"], "content": contents})


@query(
    "S7",
    sql="""SELECT 'v' || vec_id AS video_id, len(embedding) AS dim, embedding[1]::DOUBLE AS first, embedding[-1]::DOUBLE AS last,
        list_min(embedding)::DOUBLE AS low, list_max(embedding)::DOUBLE AS high FROM embeddings""",
)
def decode_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings as contents of single-vector files, read back."""
    named = views.table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("video_id"), "embedding"
    )
    files = named.mapInPandas(_as_files, "video_id string, content binary")
    vector = F.col("embedding")
    ends = {"first": F.element_at(vector, 1), "last": F.element_at(vector, -1), "low": F.array_min(vector), "high": F.array_max(vector)}
    return vectors_of(files).select(
        "video_id", F.size(vector).cast("long").alias("dim"), *[c.cast("double").alias(n) for n, c in ends.items()]
    )


@query(
    "K10", "A2",
    sql=f"""WITH {_EMBEDDED} SELECT 'run-1' AS run_id, 'EmbeddingsGenerated' AS metric,
        count(*) FILTER (coalesce(vector, '') <> '') AS value, 'Count' AS unit FROM embedded
        UNION ALL SELECT 'run-1', 'EmbeddingsFailed', count(*) FILTER (coalesce(vector, '') = ''), 'Count' FROM embedded""",
)
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "metrics")
    results = oc.embedding_result_rows(embed(_texts(spark, sf_dir), count_letters), "letters")
    if not reports.append_run_metrics(oc.embedding_summary(results), "run-1", folder):
        raise RuntimeError("metrics were not written")
    return spark.read.parquet(folder)


@query(
    "Q5", "V7", "K8", "K6", "K10", "S8",
    sql=with_views(
        f"""SELECT c.video_id, status, CASE WHEN n IS NULL THEN embedding_status WHEN coalesce(vector, '') <> '' THEN 'embedded'
            ELSE 'embedding_failed' END AS embedding_status,
        CASE WHEN coalesce(vector, '') <> '' THEN 'embeddings/' || c.video_id || '.npy' END AS embedding_s3,
        CASE WHEN n IS NOT NULL THEN error END AS embed_error, CASE WHEN n IS NOT NULL THEN '{NOW}' END AS embedded_at
        FROM catalog c LEFT JOIN (SELECT 'v' || substr(e.video_id, 2) AS video_id, 1 AS n, vector, error FROM embedded e
            JOIN catalog k ON k.video_id = 'v' || substr(e.video_id, 2) WHERE status = 'ready' AND embedding_status = 'pending')
        USING (video_id)""",
        "catalog",
        ctes=_EMBEDDED,
    ),
)
def embedding_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All waiting catalogue videos that have a text go through the embedding run."""
    folder = run_dir(spark, "embedding")
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(views.catalog(spark, sf_dir))
    content = _texts(spark, sf_dir).withColumn("video_id", F.concat(F.lit("v"), F.substr("video_id", F.lit(2))))
    now = F.lit(NOW).cast("timestamp")
    embedding.run(spark, table, content, count_letters, folder, "run-1", "letters", now, limit=None)
    current = table.read().withColumn("embedded_at", time_text("embedded_at"))
    return current.select("video_id", "status", "embedding_status", "embedding_s3", "embed_error", "embedded_at")


_LIFECYCLE = f"""{_EMBEDDED}, lived AS (SELECT doc_id AS pos, lang, CASE WHEN doc_id % 50 = 0 THEN 'http' ELSE 's3' END
        || '://raw/' || doc_id AS s3_uri, CASE WHEN quality IS NOT NULL AND doc_id % 10 <> 3 THEN 'd' || doc_id END AS video_id,
    quality IS NULL AND doc_id % 10 = 7 AS waiting,
    CASE WHEN doc_id % 50 = 0 THEN 'not an object URI: http://raw/' || doc_id WHEN waiting THEN NULL
        WHEN quality IS NULL OR doc_id % 10 = 3 THEN 'task did not complete within 1200s'
        WHEN quality = 0 THEN 'indexing failed: task t' || doc_id ELSE error END AS error, vector
    FROM documents LEFT JOIN labels USING (doc_id) JOIN embedded ON embedded.video_id = 'd' || doc_id),
    records AS (SELECT pos, s3_uri, video_id, lang, CASE WHEN error IS NOT NULL THEN 'failed' WHEN waiting THEN 'indexing' WHEN vector = '' THEN 'embedding'
        ELSE 'embedded' END AS status, error, CASE WHEN error IS NULL AND NOT waiting AND vector <> '' THEN
        'embeddings/' || video_id || '.npy' END AS embedding_s3 FROM lived)"""


def _lifecycle(spark: SparkSession, sf_dir: str) -> tuple[ChangeLog, DataFrame]:
    """Every document is an input and submitted; labels say how its task ends, and its text is what the model reads.

    Every tenth task ends at its deadline, which is too late; one in ten was submitted so recently that it may still end.
    """
    folder = run_dir(spark, "lifecycle")
    number = F.col("doc_id").cast("string")
    uri = F.concat(F.when(F.col("doc_id") % 50 == 0, "http").otherwise("s3"), F.lit("://raw/"), number)
    extra = F.create_map(F.lit("lang"), F.col("lang")).alias("metadata")
    inputs = views.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("pos"), uri.alias("s3_uri"), extra)
    now = F.lit(NOW).cast("timestamp")
    ago = F.when(F.col("doc_id") % 10 == 7, 600).otherwise(3600)
    handed_in = now - F.make_dt_interval(secs=ago)
    task = [uri.alias("s3_uri"), F.concat(F.lit("t"), number).alias("task_id")]
    submitted = views.table(spark, sf_dir, "documents").select(
        *task, F.lit(None).cast("string").alias("video_id"), F.lit("submitted").alias("status"), handed_in.alias("ts")
    )
    ends = views.table(spark, sf_dir, "labels").select(
        *task,
        F.concat(F.lit("d"), number).alias("video_id"),
        F.when(F.col("quality") == 1, "ready").otherwise("failed").alias("status"),
        (handed_in + F.make_dt_interval(secs=F.when(F.col("doc_id") % 10 == 3, 1200).otherwise(300))).alias("ts"),
    )
    events = submitted.unionByName(ends)
    table = ChangeLog(spark, f"{folder}/catalog")
    table.create(views.catalog(spark, sf_dir))
    records = lifecycle.run(
        spark, table, inputs, events, _texts(spark, sf_dir), count_letters, folder, "idx_9", "letters", now
    )
    return table, records


@query(
    "J6", "Q7", "V7", "V8", "P4",
    sql=f"WITH {_LIFECYCLE} SELECT pos, s3_uri, video_id, status, error, embedding_s3, lang FROM records",
)
def lifecycle_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = _lifecycle(spark, sf_dir)
    return records.select("pos", "s3_uri", "video_id", "status", "error", "embedding_s3", F.col("metadata")["lang"].alias("lang"))


@query(
    "K12", "K2", "S8",
    sql=with_views(
        """SELECT video_id, status, NULL AS error, NULL AS embedding_s3, NULL AS lang FROM catalog
        UNION ALL SELECT video_id, status, error, embedding_s3, lang FROM records WHERE video_id IS NOT NULL""",
        "catalog",
        ctes=_LIFECYCLE,
    ),
)
def lifecycle_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _lifecycle(spark, sf_dir)
    return table.read().select("video_id", "status", "error", "embedding_s3", F.col("metadata")["lang"].alias("lang"))


@query(
    "A3",
    sql=f"""WITH {_LIFECYCLE} SELECT count(*) FILTER (status = 'embedded') AS success,
        count(*) FILTER (status <> 'embedded') AS failed, count(*) AS total FROM records""",
)
def lifecycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, records = _lifecycle(spark, sf_dir)
    return tasks.batch_summary(records)
