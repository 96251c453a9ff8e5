"""Raw batch metadata: JSON in, dated Parquet out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.schemas import RAW_METADATA


def read_raw_metadata(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Metadata records with the declared schema. A malformed document becomes one row of nulls.

    Keep `multi_line` for files that hold one document or array each; JSON Lines files are splittable without it.
    """
    return spark.read.schema(RAW_METADATA).option("multiLine", multi_line).json(path)


def read_raw_rejects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(path, text, video_id) of the documents that could not be parsed, with the id where it could be read."""
    bad = "_corrupt_record"
    schema = T.StructType([*RAW_METADATA.fields, T.StructField(bad, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line).option("columnNameOfCorruptRecord", bad)
    rows = reader.json(path).select(F.col("_metadata.file_path").alias("path"), F.col(bad).alias("text"), "video_id")
    return rows.filter(F.col("text").isNotNull())


def write_partition(df: DataFrame, path: str, dt: str, rebalance: bool = False) -> None:
    """Replace the partition `dt=...` and leave all others alone, so a rerun gives the same table.

    `rebalance` costs a shuffle and gives files of the advisory size, which input of very many small files needs.
    """
    dated = df.withColumn("dt", F.lit(dt))
    dated = dated.hint("rebalance") if rebalance else dated
    writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("dt").parquet(path)
