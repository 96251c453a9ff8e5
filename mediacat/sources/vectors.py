"""Vector storage: a Parquet table, and a reader for single-vector `.npy` files."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.operators.catalog import vector_path


def vector_rows(df: DataFrame, model: str) -> DataFrame:
    """Storable vectors: float32, with dimension, model and path. Rows without a vector are left out."""
    kept = df.filter(F.size("embedding") > 0)
    return kept.select(
        "video_id",
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.size("embedding").alias("vector_dim"),
        vector_path(F.col("video_id")).alias("embedding_s3"),
        F.lit(model).alias("embed_model"),
    )


def write_vectors(df: DataFrame, path: str, model: str, mode: str = "append") -> None:
    """Write vectors below `embed_model=...`; `overwrite` replaces that model's vectors only."""
    writer = vector_rows(df, model).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("embed_model").parquet(path)


def read_vector_table(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if model is None else table.filter(F.col("embed_model") == model)


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        vectors = [np.load(io.BytesIO(c), allow_pickle=False).astype(np.float32).ravel() for c in batch["content"]]
        yield pd.DataFrame({"video_id": batch["video_id"], "embedding": vectors})


def decode_vectors(files: DataFrame) -> DataFrame:
    """(video_id, embedding) of rows (video_id, content) that hold a `.npy` file each."""
    return files.select("video_id", "content").mapInPandas(_decode, "video_id string, embedding array<float>")


def read_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(video_id, embedding) of all `{video_id}.npy` files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy")
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.npy\z", "")
    return decode_vectors(files.load(folder).select(name.alias("video_id"), "content"))


def missing_vectors(vectors: DataFrame, wanted: DataFrame) -> DataFrame:
    """Ids that have no stored vector."""
    return wanted.select("video_id").distinct().join(vectors.select("video_id"), "video_id", "left_anti")
