"""The batch metadata job: JSON metadata to a dated, derived Parquet partition.

    python -m mediacat.plans.batch_metadata --input s3a://bucket/metadata/ --output s3a://bucket/processed/ --dt 2024-01-15
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mediacat.functions import metadata as fm
from mediacat.functions.objects import size_mb
from mediacat.session import build_session
from mediacat.sources.metadata import read_raw_metadata, write_partition

RAW_ONLY = ("created_at", "indexed_at", "width", "height", "file_size_bytes")


def drop_blank_id(df: DataFrame) -> DataFrame:
    return df.filter(F.col("video_id").isNotNull() & (F.col("video_id") != ""))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Leave out the columns that are null in every row; costs one pass over the data."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if filled[c] > 0])


def transform(df: DataFrame, status_mode: str = "reference", strict_resolution: bool = False) -> DataFrame:
    """Derived columns for rows with an id; the raw columns they come from are dropped."""
    derived = drop_blank_id(df).withColumns(
        {
            "created_at_ts": fm.parse_time(F.col("created_at")),
            "indexed_at_ts": fm.parse_time(F.col("indexed_at")),
            "file_size_mb": size_mb(F.col("file_size_bytes"), half_even=False),
            "resolution": fm.resolution(F.col("width"), F.col("height"), strict_resolution),
            "has_embedding": F.col("embedding_s3").isNotNull(),
            "status_normalized": fm.status_normalized(F.col("status"), status_mode),
        }
    )
    latency = fm.latency_sec(F.col("created_at_ts"), F.col("indexed_at_ts"))
    return derived.withColumn("indexing_latency_sec", latency).drop(*RAW_ONLY)


def utc_today() -> str:
    return datetime.now(tz=timezone.utc).strftime("%Y-%m-%d")


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    dt: str | None = None,
    drop_empty: bool = False,
    multi_line: bool = True,
) -> dict[str, int]:
    """Read, derive and write one partition in a single pass; returns the rows read and written.

    With `multi_line` the input is one document or array per file, so the output is rebalanced into fewer files.
    """
    read, written = Observation("read"), Observation("written")
    raw = read_raw_metadata(spark, input_path, multi_line).observe(read, F.count(F.lit(1)).alias("rows"))
    out = transform(raw)
    out = (drop_null_columns(out) if drop_empty else out).observe(written, F.count(F.lit(1)).alias("rows"))
    write_partition(out, output_path, dt or utc_today(), rebalance=multi_line)
    return {"read": read.get["rows"], "written": written.get["rows"]}


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--dt", help="partition date, default today in UTC")
    parser.add_argument("--drop-empty-columns", action="store_true")
    parser.add_argument("--json-lines", action="store_true", help="input has one record per line and can be split")
    args = parser.parse_args()
    spark = build_session("batch-metadata")
    counts = run(spark, args.input, args.output, args.dt, args.drop_empty_columns, not args.json_lines)
    print(f"rows read {counts['read']}, written {counts['written']}")


if __name__ == "__main__":
    main()
