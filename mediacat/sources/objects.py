"""Object listings: from files, from a listing table, by key, and with tags."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.functions import objects as fo


def list_files(spark: SparkSession, root: str, bucket: str, modified_after: str | None = None) -> DataFrame:
    """Raw listing of all files below a folder; the key is the path relative to it. File contents are not read.

    For very many objects use a listing table (an inventory report) instead: a folder is listed by the driver.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return file_listing(reader.load(root), root, bucket)


def file_listing(files: DataFrame, root: str, bucket: str) -> DataFrame:
    """Listing columns of a file source. The path may spell the scheme of the root in another way."""
    folder = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    folder = folder.rstrip("/") + "/"
    return files.select(
        F.lit(bucket).alias("bucket"),
        F.substr("path", F.locate(folder, F.col("path")) + F.lit(len(folder))).alias("s3_key"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("last_modified"),
        F.lit(None).cast("string").alias("etag"),
    )


def describe(objects: DataFrame) -> DataFrame:
    """Listing rows with uri, size in MB, clean etag and content type. No row is left out."""
    key = F.col("s3_key")
    return objects.select(
        "bucket",
        "s3_key",
        fo.object_uri(F.col("bucket"), key).alias("s3_uri"),
        "size_bytes",
        fo.size_mb(F.col("size_bytes")).alias("size_mb"),
        "last_modified",
        fo.clean_etag(F.col("etag")).alias("etag"),
        fo.content_type(key).alias("content_type"),
    )


def list_objects(objects: DataFrame, prefix: str = "") -> DataFrame:
    """The video objects of a listing, below a key prefix."""
    rows = objects.filter(F.col("s3_key").startswith(prefix)) if prefix else objects
    return describe(rows.filter(fo.is_video(F.col("s3_key"))))


def list_objects_since(objects: DataFrame, watermark: datetime | str, prefix: str = "") -> DataFrame:
    """Video objects modified after the watermark, strictly. Naive times are UTC."""
    if isinstance(watermark, datetime):
        aware = watermark if watermark.tzinfo else watermark.replace(tzinfo=timezone.utc)
        text = aware.isoformat(sep=" ")
    else:
        text = watermark
    return list_objects(objects.filter(F.col("last_modified") > F.lit(text).cast("timestamp")), prefix)


def select_keys(objects: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested keys (`pos`, `s3_key`) that exist, in request order, repeats kept. Any file type counts."""
    found = requested.select("pos", "s3_key").join(describe(objects), "s3_key", "inner")
    return found.orderBy("pos")


def missing_keys(objects: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested keys that do not exist."""
    return requested.join(objects.select("s3_key"), "s3_key", "left_anti")


def attach_tags(objects: DataFrame, tags: DataFrame) -> DataFrame:
    """Objects with a `tags` map; an empty map where there are none. `tags` holds (s3_key, tag, value, seq).

    Repeats of a tag are reduced to the last one before the map is built, so a map has one entry per distinct tag, of
    which object stores allow ten.
    """
    last = tags.filter(F.col("tag").isNotNull()).groupBy("s3_key", "tag").agg(F.max_by("value", "seq").alias("value"))
    maps = last.groupBy("s3_key").agg(F.map_from_entries(F.collect_list(F.struct("tag", "value"))).alias("tags"))
    none = F.create_map().cast("map<string,string>")
    return objects.join(maps, "s3_key", "left").withColumn("tags", F.coalesce("tags", none))
