"""The given tables in the shapes that the operators take, in Spark and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.schemas import MODALITIES

# What object number doc_id % 12 and doc_id % 11 get.
EXTENSIONS = (".mp4", ".MOV", ".avi", ".mkv", ".webm", ".flv", ".m4v", ".ts", ".wmv", ".txt", ".json", "")
OBJECT_STATUSES = ("pending", "indexing", "indexed", "embedding", "embedded", "failed", "skipped", "ready")
EVENT_STATUSES = {
    "signup": "submitted", "purchase": "ready", "error": "failed", "view": "indexing", "click": "pending",
}
START = "2024-01-01 00:00:00"


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once and not for every query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def time_text(ts: Column | str) -> Column:
    """Times leave the queries as text, which reads the same in every engine and time zone."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _pick(position: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _minutes_after_start(minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(F.lit(START).cast("timestamp")) + minutes * 60_000_000)


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("doc_id")
    key = F.concat(F.lit("raw/"), "source", F.lit("/"), "lang", F.lit("/doc_"), n.cast("string"), _pick(n % 12, EXTENSIONS))
    video_id = F.when(n % 5 == 0, None).when(n % 7 == 0, "").otherwise(F.concat(F.lit(" vid_"), n.cast("string"), F.lit(" ")))
    uri = F.concat(F.when(n % 50 == 0, "http://").otherwise("s3://"), F.lit("raw/raw/"), n.cast("string"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.lit("raw").alias("bucket"),
        key.alias("s3_key"),
        (F.col("n_chars") * 131072).alias("size_bytes"),
        _minutes_after_start(n).alias("last_modified"),
        F.concat(F.lit('"'), F.md5("text"), F.lit('"')).alias("etag"),
        F.concat(F.lit("idx_"), (n % 4).cast("string")).alias("index_id"),
        video_id.alias("video_id"),
        F.when(n % 11 < 8, _pick(n % 11, OBJECT_STATUSES)).alias("status"),
        F.when(n % 6 < 3, _pick(n % 6, ("1920x1080", "1280x720", "bad"))).alias("resolution"),
        F.when(n % 3 == 0, F.col("n_chars") / 8 + 0.5).alias("size_mb"),
        uri.alias("s3_uri"),
    )


def _order_status() -> Column:
    n = F.col("o_orderkey")
    open_status = F.when(n % 3 == 1, "indexing").when(n % 3 == 2, "embedded")
    status = F.when(F.col("o_orderstatus") == "F", "ready")
    return status.when(F.col("o_orderstatus") == "P", F.when(n % 2 == 0, "failed").otherwise("timeout")).otherwise(open_status)


def raw_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, date = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    indexed = F.timestamp_seconds(F.unix_timestamp(date) + n % 7200 - 600)
    named = F.concat(F.lit("v"), n.cast("string"))
    return table(spark, sf_dir, "orders").withColumn("status", _order_status()).select(
        F.when(n % 97 == 0, None).when(n % 89 == 0, "").otherwise(named).alias("video_id"),
        F.concat(F.lit("raw/"), n.cast("string"), F.lit(".mp4")).alias("s3_key"),
        F.concat(F.lit("idx_"), (F.col("o_custkey") % 4).cast("string")).alias("index_id"),
        "status",
        (F.col("o_totalprice") / 100).alias("duration_sec"),
        (n * 131072).alias("file_size_bytes"),
        F.when(n % 10 != 0, 1920).alias("width"),
        F.when(n % 15 != 0, 1080).alias("height"),
        F.when(n % 2 == 0, 30.0).otherwise(24.0).alias("fps"),
        time_text(date).alias("created_at"),
        F.when(n % 101 == 0, "n/a").when(F.col("o_orderstatus") == "F", time_text(indexed)).alias("indexed_at"),
        F.when(F.col("status") == "embedded", F.concat(F.lit("embeddings/"), named, F.lit(".npy"))).alias("embedding_s3"),
        F.col("o_orderpriority").alias("source"),
        F.lit('["a"]').alias("tags"),
    )


def task_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.create_map(*[F.lit(x) for pair in EVENT_STATUSES.items() for x in pair])
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), status[F.col("event_type")].alias("status"), "value"
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("c_custkey")
    status = F.when(n % 6 < 5, _pick(n % 6, ("ready", "embedded", "failed", "indexing", "ready")))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("v"), n.cast("string")).alias("video_id"),
        F.concat(F.lit("idx_"), (n % 4).cast("string")).alias("index_id"),
        status.alias("status"),
        F.when(n % 6 == 0, "pending").when(n % 6 == 1, "embedded").otherwise("skipped").alias("embedding_status"),
        _minutes_after_start(n).alias("created_at"),
        F.col("c_mktsegment").alias("source"),
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("v"), (F.col("o_custkey") + 300).cast("string")).alias("video_id"),
        _order_status().alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        n.alias("clip_id"),
        F.concat(F.lit("v"), F.col("label").cast("string")).alias("video_id"),
        _pick(n % 4, MODALITIES).alias("modality"),
        (n * 5.0).alias("start_sec"),
        (n * 5.0 + 5).alias("end_sec"),
        "embedding",
    )


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label: the embedding of its first vector."""
    first = F.min_by("embedding", "vec_id").alias("embedding")
    return table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("query_id")).agg(first)


def first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query: the first embedding of the table."""
    first = F.min_by("embedding", "vec_id").alias("embedding")
    return table(spark, sf_dir, "embeddings").agg(F.lit(0).alias("query_id"), first)


_ORDER_STATUS = """CASE o_orderstatus WHEN 'F' THEN 'ready'
    WHEN 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'failed' ELSE 'timeout' END
    ELSE CASE o_orderkey % 3 WHEN 1 THEN 'indexing' WHEN 2 THEN 'embedded' END END"""

_TIME = "'%Y-%m-%d %H:%M:%S'"

SQL = {
    "objects": """objects AS (SELECT doc_id, 'raw' AS bucket,
        'raw/' || source || '/' || lang || '/doc_' || doc_id || CASE doc_id % 12 WHEN 0 THEN '.mp4' WHEN 1 THEN '.MOV'
            WHEN 2 THEN '.avi' WHEN 3 THEN '.mkv' WHEN 4 THEN '.webm' WHEN 5 THEN '.flv' WHEN 6 THEN '.m4v'
            WHEN 7 THEN '.ts' WHEN 8 THEN '.wmv' WHEN 9 THEN '.txt' WHEN 10 THEN '.json' ELSE '' END AS s3_key,
        n_chars * 131072 AS size_bytes,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS last_modified,
        '"' || md5(text) || '"' AS etag,
        'idx_' || (doc_id % 4) AS index_id,
        CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN '' ELSE ' vid_' || doc_id || ' ' END AS video_id,
        CASE doc_id % 11 WHEN 0 THEN 'pending' WHEN 1 THEN 'indexing' WHEN 2 THEN 'indexed' WHEN 3 THEN 'embedding'
            WHEN 4 THEN 'embedded' WHEN 5 THEN 'failed' WHEN 6 THEN 'skipped' WHEN 7 THEN 'ready' END AS status,
        CASE doc_id % 6 WHEN 0 THEN '1920x1080' WHEN 1 THEN '1280x720' WHEN 2 THEN 'bad' END AS resolution,
        CASE WHEN doc_id % 3 = 0 THEN n_chars / 8 + 0.5 END AS size_mb,
        CASE WHEN doc_id % 50 = 0 THEN 'http://raw/raw/' ELSE 's3://raw/raw/' END || doc_id AS s3_uri
        FROM documents)""",
    "raw_metadata": f"""raw_metadata AS (SELECT
        CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '' ELSE 'v' || o_orderkey END AS video_id,
        'raw/' || o_orderkey || '.mp4' AS s3_key, 'idx_' || (o_custkey % 4) AS index_id,
        {_ORDER_STATUS} AS status, o_totalprice / 100 AS duration_sec, o_orderkey * 131072 AS file_size_bytes,
        CASE WHEN o_orderkey % 10 <> 0 THEN 1920 END AS width, CASE WHEN o_orderkey % 15 <> 0 THEN 1080 END AS height,
        CASE WHEN o_orderkey % 2 = 0 THEN 30.0::DOUBLE ELSE 24.0::DOUBLE END AS fps,
        strftime(o_orderdate, {_TIME}) AS created_at,
        CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' WHEN o_orderstatus = 'F'
            THEN strftime(o_orderdate + to_seconds(o_orderkey % 7200 - 600), {_TIME}) END AS indexed_at,
        CASE WHEN o_orderstatus NOT IN ('F', 'P') AND o_orderkey % 3 = 2
            THEN 'embeddings/v' || o_orderkey || '.npy' END AS embedding_s3,
        o_orderpriority AS source, '["a"]' AS tags FROM orders)""",
    "task_events": """task_events AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'signup' THEN 'submitted'
        WHEN 'purchase' THEN 'ready' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'indexing' WHEN 'click' THEN 'pending'
        END AS status, value FROM events)""",
    "catalog": """catalog AS (SELECT 'v' || c_custkey AS video_id, 'idx_' || (c_custkey % 4) AS index_id,
        CASE c_custkey % 6 WHEN 0 THEN 'ready' WHEN 1 THEN 'embedded' WHEN 2 THEN 'failed' WHEN 3 THEN 'indexing'
            WHEN 4 THEN 'ready' END AS status,
        CASE c_custkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'embedded' ELSE 'skipped' END AS embedding_status,
        TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS created_at, c_mktsegment AS source FROM customer)""",
    "updates": f"""updates AS (SELECT 'v' || (o_custkey + 300) AS video_id, {_ORDER_STATUS} AS status,
        o_orderdate AS updated_at, o_orderkey AS seq FROM orders)""",
    "vectors": """vectors AS (SELECT vec_id AS clip_id, 'v' || label AS video_id,
        CASE vec_id % 4 WHEN 0 THEN 'visual' WHEN 1 THEN 'conversation' WHEN 2 THEN 'text_in_video' ELSE 'logo' END
            AS modality, vec_id * 5.0::DOUBLE AS start_sec, vec_id * 5.0::DOUBLE + 5 AS end_sec,
        embedding::DOUBLE[] AS embedding FROM embeddings)""",
    "label_queries": """label_queries AS (SELECT label AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS embedding
        FROM embeddings GROUP BY label)""",
    "first_query": """first_query AS (SELECT 0 AS query_id, arg_min(embedding, vec_id)::DOUBLE[] AS embedding
        FROM embeddings)""",
}


def with_views(body: str, *names: str, ctes: str = "") -> str:
    """SQL with the named views in front; `ctes` holds further ones."""
    parts = [SQL[n] for n in names] + ([ctes] if ctes else [])
    return f"WITH {', '.join(parts)} {body}"
