"""Manifests: JSON files that queue records for the next run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.functions.metadata import compact
from mediacat.schemas import VIDEO

# A manifest record is a catalogue record, with times as text and an optional signed address.
MANIFEST = T.StructType(
    [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in VIDEO]
    + [T.StructField("presigned_url", T.StringType())]
)


def default_run_id(now: datetime | None = None) -> str:
    return (now or datetime.now(tz=timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def write_manifest(df: DataFrame, folder: str, run_id: str | None = None, order: str = "s3_key") -> str:
    """Write the records below `folder/run_id/` as JSON Lines in many files, sorted, nulls left out; returns that path.

    A run id that exists already is replaced.
    """
    path = f"{folder.rstrip('/')}/{run_id or default_run_id()}"
    fields = [compact(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    df.orderBy(order).select(*fields).write.mode("overwrite").option("ignoreNullFields", True).json(path)
    return path


def manifest_path(file: Column) -> Column:
    """Path of the manifest a file belongs to: its folder for a part file, else the file itself."""
    name = F.substring_index(file, "/", -1)
    folder = F.left(file, F.length(file) - F.length(name) - 1)
    return F.when(name.startswith("part-"), folder).otherwise(file)


def oldest_manifest(spark: SparkSession, folder: str) -> str | None:
    """Path of the manifest that was modified first, a folder or a single file; None if there is none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    listed = files.load(folder).filter(F.col("length") > 0)
    oldest = listed.groupBy(manifest_path(F.col("path")).alias("path")).agg(F.min("modificationTime").alias("at"))
    first = oldest.orderBy("at", "path").limit(1).first()
    return first["path"] if first else None


def read_manifest(
    spark: SparkSession, path: str, limit: int | None = None, schema: T.StructType = MANIFEST
) -> DataFrame:
    """Records of one manifest with their position; with `limit` the first ones in file order.

    A folder holds JSON Lines, a single `.json` file holds one array.
    """
    if path.endswith(".json"):
        rows = spark.read.schema(schema).option("multiLine", True).json(path)
        rows = rows.select(F.monotonically_increasing_id().alias("position"), "*")
    else:
        text = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
        rows = text.select(
            F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("row")).alias("position"),
            F.from_json("value", schema).alias("record"),
        ).select("position", "record.*")
    return rows if limit is None else rows.orderBy("position").limit(limit)


def read_manifests(spark: SparkSession, folder: str, limit: int | None = None) -> DataFrame:
    """The records of the oldest manifest, with `limit` the first ones; no rows when there is no manifest."""
    found = oldest_manifest(spark, folder)
    if found is None:
        return spark.createDataFrame([], MANIFEST)
    return read_manifest(spark, found, limit).drop("position")
