"""Streams over arriving files: new objects and the manifest queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mediacat.functions import objects as fo
from mediacat.schemas import OBJECT_LISTING
from mediacat.sources.manifests import MANIFEST
from mediacat.sources.objects import describe, file_listing


def stream_files(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """Video objects as their files arrive below a folder; contents are not read.

    The checkpoint remembers files and not a time, so an object as old as the newest one seen is not lost.
    """
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.schema("path string, modificationTime timestamp, length long, content binary").load(root)
    return describe(file_listing(files, root, bucket).filter(fo.is_video(F.col("s3_key"))))


def stream_listing(spark: SparkSession, path: str, schema: StructType = OBJECT_LISTING) -> DataFrame:
    """Video objects of a listing table that grows by Parquet files."""
    rows = spark.readStream.schema(schema).parquet(path)
    return describe(rows.filter(fo.is_video(F.col("s3_key"))))


def stream_manifests(
    spark: SparkSession, folder: str, archive: str | None = None, array_files: bool = True, files_per_batch: int = 1
) -> DataFrame:
    """Manifest records, oldest file first, `files_per_batch` files per batch.

    With `archive`, a file moves there once a later batch has committed; a file that was not read is never moved.
    """
    reader = spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", files_per_batch)
    reader = reader.option("latestFirst", False).option("multiLine", array_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)
