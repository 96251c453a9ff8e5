"""Enrichment and validation of catalogue records; bad rows are kept aside with their error codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.functions import objects as fo
from mediacat.schemas import (
    DEFAULT_SOURCE,
    EMBEDDING_STATUSES,
    NON_NEGATIVE,
    REQUIRED,
    SIZE_TOLERANCE_MB,
    STATUSES,
    VIDEO,
)


def coerce(df: DataFrame) -> DataFrame:
    """Give every canonical column its declared type; `type_errors` lists the columns that did not convert.

    Numeric text is accepted, a fractional value in an integer column is not. Absent columns become null.
    """
    errors, columns = [], []
    for field in VIDEO.fields:
        name, target = field.name, field.dataType
        if name not in df.columns:
            columns.append(F.lit(None).cast(target).alias(name))
            continue
        source, given = F.col(name), df.schema[name].dataType
        value = source
        if isinstance(target, T.LongType):
            if isinstance(given, T.StringType):
                source = fo.strip_blanks(source)
            if isinstance(given, (T.DoubleType, T.FloatType, T.DecimalType, T.StringType)):
                wide = source.try_cast("decimal(38,9)")
                value = F.when(wide % 1 == 0, wide.try_cast(target))
            else:
                value = source.cast(target)
        elif given != target:
            source = fo.strip_blanks(source) if isinstance(given, T.StringType) else source
            value = source.try_cast(target)
        if value is not source:
            errors.append(F.when(source.isNotNull() & value.isNull(), F.lit(f"type:{name}")))
        columns.append(value.alias(name))
    found = F.array_compact(F.array(*errors)) if errors else F.array()
    extras = [c for c in df.columns if c not in VIDEO.names]
    return df.select(*columns, *extras, found.cast("array<string>").alias("type_errors"))


def enrich(df: DataFrame, index_id: str | None, now: Column, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Fill ids, sizes and defaults. A null counts as absent, since a column cannot tell the two apart."""
    fill = {
        "index_id": F.lit(index_id).cast("string"),
        "source": F.lit(source),
        "status": F.lit("pending"),
        "embedding_status": F.lit("pending"),
        "content_type": F.lit("video/mp4"),
        "etag": F.lit(""),
        "created_at": now,
        "tags": F.create_map().cast("map<string,string>"),
        "size_mb": fo.size_mb(F.col("size_bytes")),
    }
    failed = {"size_mb": "type:size_mb", "created_at": "type:created_at", "tags": "type:tags"}
    changed = {}
    for name, default in fill.items():
        if name in failed:  # a value that did not convert is an error, not an absent value
            default = F.when(~F.array_contains("type_errors", failed[name]), default)
        changed[name] = F.coalesce(F.col(name), default)
    changed["video_id"] = fo.derive_video_id(F.col("video_id"), F.col("s3_uri"), F.col("s3_key"))
    return df.withColumns(changed)


def _rules() -> list[Column]:
    key, uri = F.col("s3_key"), F.col("s3_uri")
    rules = [
        F.when(F.col(c).isNull() & ~F.array_contains("type_errors", f"type:{c}"), F.lit(f"missing:{c}"))
        for c in REQUIRED
    ]
    rules += [
        F.when(~F.col("status").isin(*STATUSES), "bad:status"),
        F.when(~F.col("embedding_status").isin(*EMBEDDING_STATUSES), "bad:embedding_status"),
        F.when((key == "") | key.startswith("/"), "bad:s3_key"),
        F.when(~uri.startswith("s3://"), "bad:s3_uri"),
        F.when(~F.col("resolution").rlike(r"^\p{Nd}+x\p{Nd}+\n?\z"), "bad:resolution"),
    ]
    for name in NON_NEGATIVE:
        value = F.col(name)
        negative = value < 0 if name == "size_bytes" else (value < 0) | F.isnan(value)
        rules.append(F.when(negative, f"negative:{name}"))
    return rules


def check(df: DataFrame) -> DataFrame:
    """Add `errors`, normalise the text fields and correct sizes that disagree with the byte count."""
    rows = df.withColumn("errors", F.concat("type_errors", F.array_compact(F.array(*_rules())))).drop("type_errors")
    expected = fo.size_mb(F.col("size_bytes"))
    off = F.coalesce(F.abs(expected - F.col("size_mb")) > SIZE_TOLERANCE_MB, F.lit(False))
    return rows.withColumns(
        {
            "video_id": fo.strip_blanks(F.col("video_id")),
            "s3_key": fo.strip_blanks(F.col("s3_key")),
            "content_type": fo.strip_blanks(F.lower("content_type")),
            "size_mb": F.when(off, expected).otherwise(F.col("size_mb")),
            "size_corrected": off,
        }
    )


def checked(
    df: DataFrame, index_id: str | None = None, now: Column | None = None, source: str = DEFAULT_SOURCE
) -> DataFrame:
    """All rows, enriched and normalised, with their `errors`."""
    return check(enrich(coerce(df), index_id, F.current_timestamp() if now is None else now, source))


def validate(
    df: DataFrame, index_id: str | None = None, now: Column | None = None, source: str = DEFAULT_SOURCE
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejects): rejects carry their error codes, valid rows have the canonical columns.

    Using both reads the input twice; `write_checked` splits it in one pass.
    """
    rows = checked(df, index_id, now, source)
    valid = rows.filter(F.size("errors") == 0).drop("errors")
    return valid, rows.filter(F.size("errors") > 0).drop("size_corrected")


def write_checked(rows: DataFrame, path: str) -> None:
    """Write checked rows below `valid=true` and `valid=false`."""
    split = rows.withColumn("valid", F.size("errors") == 0)
    split.write.mode("overwrite").partitionBy("valid").parquet(path)


def validation_summary(
    df: DataFrame, index_id: str | None = None, now: Column | None = None, source: str = DEFAULT_SOURCE
) -> DataFrame:
    """One row with the counts of valid, invalid and size-corrected records."""
    good = F.size("errors") == 0
    return checked(df, index_id, now, source).agg(
        F.count_if(good).alias("valid"),
        F.count_if(~good).alias("invalid"),
        F.count_if(good & F.col("size_corrected")).alias("size_corrected"),
    )
