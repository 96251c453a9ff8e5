"""Queries over raw batch metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.functions import metadata as fm
from mediacat.operators import reports
from mediacat.plans import batch_metadata, views
from mediacat.plans.registry import query
from mediacat.plans.views import time_text, with_views
from mediacat.session import run_dir
from mediacat.sources.metadata import read_raw_metadata, write_partition

_TRANSFORM = """SELECT video_id, s3_key, index_id, status, duration_sec, fps, embedding_s3, source, tags,
    strftime(try_cast(created_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS created_at_ts,
    strftime(try_cast(indexed_at AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS indexed_at_ts,
    round(file_size_bytes / 1048576, 2) AS file_size_mb,
    concat_ws('x', width::VARCHAR, height::VARCHAR) AS resolution,
    embedding_s3 IS NOT NULL AS has_embedding,
    CASE WHEN status = 'ready' THEN 'indexed' WHEN status IN ('failed', 'timeout') THEN 'failed' ELSE 'pending' END
        AS status_normalized,
    epoch(try_cast(indexed_at AS TIMESTAMP))::BIGINT - epoch(try_cast(created_at AS TIMESTAMP))::BIGINT
        AS indexing_latency_sec
    FROM raw_metadata WHERE video_id IS NOT NULL AND video_id <> ''"""


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in ("created_at_ts", "indexed_at_ts")})


@query("P5", "P9", "P10", "P11", "P12", "P13", "P14", "P15", sql=with_views(_TRANSFORM, "raw_metadata"))
def batch_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(batch_metadata.transform(views.raw_metadata(spark, sf_dir)))


@query("S1", "K1", "P15", sql=with_views(f"SELECT *, '2024-01-15' AS dt FROM ({_TRANSFORM})", "raw_metadata"))
def batch_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON in, dated Parquet out and read back."""
    folder = run_dir(spark, "batch")
    views.raw_metadata(spark, sf_dir).write.json(f"{folder}/raw")
    raw = read_raw_metadata(spark, f"{folder}/raw", multi_line=False)
    write_partition(batch_metadata.transform(raw), f"{folder}/out", "2024-01-15")
    written = spark.read.parquet(f"{folder}/out")
    return _shown(written).withColumn("dt", F.col("dt").cast("string"))


@query(
    "S1",
    sql=with_views(
        """SELECT video_id, s3_key, index_id, status, duration_sec, file_size_bytes, width, height, fps, created_at,
        indexed_at, embedding_s3, source, tags FROM raw_metadata""",
        "raw_metadata",
    ),
)
def read_metadata_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "metadata")
    views.raw_metadata(spark, sf_dir).write.json(folder)
    return read_raw_metadata(spark, folder, multi_line=False)


@query(
    "P13",
    sql=with_views(
        """SELECT status, CASE WHEN status = 'ready' THEN 'indexed'
        WHEN status IN ('failed', 'timeout', 'upload_failed') THEN 'failed'
        WHEN status IN ('pending', 'indexing', 'indexed', 'embedding', 'embedded', 'failed', 'skipped') THEN status
        ELSE 'pending' END AS status_normalized, count(*) AS videos
        FROM raw_metadata GROUP BY ALL""",
        "raw_metadata",
    ),
)
def status_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = fm.status_normalized(F.col("status"), "full").alias("status_normalized")
    return views.raw_metadata(spark, sf_dir).groupBy("status", normal).agg(F.count(F.lit(1)).alias("videos"))


@query(
    "A8",
    sql=with_views(
        f"""SELECT status_normalized, source, count(*) AS videos, count(*) FILTER (has_embedding) AS with_embedding,
        count(indexing_latency_sec) AS with_latency, min(indexing_latency_sec) AS min_latency_sec,
        max(indexing_latency_sec) AS max_latency_sec FROM ({_TRANSFORM}) GROUP BY status_normalized, source""",
        "raw_metadata",
    ),
)
def status_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_profile(batch_metadata.transform(views.raw_metadata(spark, sf_dir)), "source")


@query(
    "A8",
    sql=with_views(
        f"""SELECT status_normalized, count(*) AS videos, quantile_disc(indexing_latency_sec, 0.5) AS p50_sec,
        quantile_disc(indexing_latency_sec, 0.9) AS p90_sec, quantile_disc(indexing_latency_sec, 0.99) AS p99_sec
        FROM ({_TRANSFORM}) WHERE indexing_latency_sec IS NOT NULL GROUP BY status_normalized""",
        "raw_metadata",
    ),
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latency_quantiles(batch_metadata.transform(views.raw_metadata(spark, sf_dir)), "status_normalized")


@query(
    "A8",
    sql=with_views(
        f"""SELECT source, count(*) AS videos, quantile_disc(indexing_latency_sec::BIGINT, 0.5) AS p50_sec,
        quantile_disc(indexing_latency_sec::BIGINT, 0.9) AS p90_sec, quantile_disc(indexing_latency_sec::BIGINT, 0.99) AS p99_sec
        FROM ({_TRANSFORM}) WHERE indexing_latency_sec IS NOT NULL AND day(created_at_ts::TIMESTAMP) BETWEEN 2 AND 20 GROUP BY source""",
        "raw_metadata",
    ),
)
def latency_over_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latencies per source over a range of days, from sketches that are stored per day and source."""
    folder = run_dir(spark, "sketches")
    batch = batch_metadata.transform(views.raw_metadata(spark, sf_dir)).withColumn("day", F.dayofmonth("created_at_ts"))
    reports.latency_sketches(batch, "day", "source").write.partitionBy("day").parquet(folder)
    return reports.merged_quantiles(spark.read.parquet(folder).filter(F.col("day").between(2, 20)), "source")


@query("P16", sql=with_views(_TRANSFORM, "raw_metadata"))
def drop_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column without any value is left out again."""
    derived = batch_metadata.transform(views.raw_metadata(spark, sf_dir))
    return _shown(batch_metadata.drop_null_columns(derived.withColumn("error", F.lit(None).cast("string"))))


@query(
    "P10",
    sql=with_views("SELECT s3_key, width || 'x' || height AS resolution, 'a' AS tag FROM raw_metadata", "raw_metadata"),
)
def strict_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = fm.resolution(F.col("width"), F.col("height"), strict=True)
    tag = F.explode(F.map_keys(fm.tags_map(F.col("tags"))))
    return views.raw_metadata(spark, sf_dir).select("s3_key", size.alias("resolution"), tag.alias("tag"))
