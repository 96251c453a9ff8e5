"""Validation rules on hand-made records."""

import pytest
from pyspark.sql import functions as F

from mediacat.operators.validate import checked, validate, validation_summary, write_checked
from mediacat.schemas import VIDEO

GOOD = {
    "video_id": "v1", "s3_key": "raw/a.mp4", "s3_uri": "s3://b/raw/a.mp4", "index_id": "idx", "size_bytes": "1048576",
    "size_mb": 1.0, "last_modified": "2024-01-01 00:00:00", "status": "pending", "embedding_status": "pending",
    "duration_sec": 1.0, "fps": 24.0, "resolution": "1920x1080", "content_type": " VIDEO/MP4 ",
}
DDL = ", ".join(f"`{k}` {'double' if isinstance(v, float) else 'string'}" for k, v in GOOD.items())


def run(spark, **changes):
    row = {**GOOD, **changes}
    df = spark.createDataFrame([tuple(row[k] for k in GOOD)], DDL)
    return checked(df, now=F.lit("2024-06-01").cast("timestamp")).first()


BAD = [
    ({"s3_key": None}, ["missing:s3_key"]),
    ({"s3_uri": None}, ["missing:s3_uri"]),
    ({"index_id": None}, ["missing:index_id"]),
    ({"last_modified": None}, ["missing:last_modified"]),
    ({"last_modified": "yesterday"}, ["type:last_modified"]),
    ({"size_bytes": None}, ["missing:size_bytes"]),
    ({"size_bytes": "1.5"}, ["type:size_bytes"]),
    ({"size_bytes": "many"}, ["type:size_bytes"]),
    ({"size_bytes": "-1"}, ["negative:size_bytes"]),
    ({"size_mb": -0.5}, ["negative:size_mb"]),
    ({"size_mb": float("nan")}, ["negative:size_mb"]),
    ({"duration_sec": -1.0}, ["negative:duration_sec"]),
    ({"fps": float("nan")}, ["negative:fps"]),
    ({"status": "ready"}, ["bad:status"]),
    ({"embedding_status": "indexed"}, ["bad:embedding_status"]),
    ({"s3_key": ""}, ["bad:s3_key"]),
    ({"s3_key": "/a"}, ["bad:s3_key"]),
    ({"s3_uri": "http://b/a"}, ["bad:s3_uri"]),
    ({"resolution": "1920 x 1080"}, ["bad:resolution"]),
    ({"resolution": "x1080"}, ["bad:resolution"]),
    ({"status": "x", "s3_uri": "x"}, ["bad:status", "bad:s3_uri"]),
]


@pytest.mark.parametrize("changes, errors", BAD)
def test_bad_rows(spark, changes, errors):
    assert run(spark, **changes).errors == errors


GOOD_ROWS = [
    ({}, {"content_type": "video/mp4", "size_bytes": 1048576, "size_corrected": False}),
    ({"size_bytes": " 1048576.0 "}, {"size_bytes": 1048576}),
    ({"video_id": None}, {}),
    ({"video_id": " v "}, {"video_id": "v"}),
    ({"s3_key": " /a "}, {"s3_key": "/a"}),
    ({"s3_key": "  "}, {"s3_key": ""}),
    ({"status": None, "embedding_status": None}, {"status": "pending", "embedding_status": "pending"}),
    ({"size_mb": None}, {"size_mb": 1.0, "size_corrected": False}),
    ({"size_mb": 1.11}, {"size_mb": 1.0, "size_corrected": True}),
    ({"size_mb": 1.09}, {"size_mb": 1.09, "size_corrected": False}),
    ({"resolution": "1920x1080\n"}, {}),
    ({"resolution": None}, {"resolution": None}),
    ({"resolution": "١x٢"}, {}),
    ({"duration_sec": None, "fps": 0.0}, {"duration_sec": None, "fps": 0.0}),
]


@pytest.mark.parametrize("changes, expected", GOOD_ROWS)
def test_good_rows(spark, changes, expected):
    row = run(spark, **changes)
    assert row.errors == []
    assert {k: row[k] for k in expected} == expected


def test_defaults(spark):
    df = spark.createDataFrame([("raw/a.mp4", "s3://b/raw/a.mp4", 10)], "s3_key string, s3_uri string, size_bytes long")
    df = df.withColumn("last_modified", F.lit("2024-01-01").cast("timestamp_ntz"))
    valid, _ = validate(df, index_id="idx", source="batch")
    row = valid.first()
    assert valid.columns == [*VIDEO.names, "size_corrected"]
    assert (row.index_id, row.source, row.tags, row.etag, row.size_mb) == ("idx", "batch", {}, "", 0.0)
    assert row.created_at is not None and row.video_id.startswith("derived_")


def test_valid_and_rejects_add_up(spark, folder):
    rows = [tuple({**GOOD, **c}[k] for k in GOOD) for c, _ in BAD + GOOD_ROWS]
    df = spark.createDataFrame(rows, DDL)
    valid, rejects = validate(df)
    assert (valid.count(), rejects.count()) == (len(GOOD_ROWS), len(BAD))
    counts = validation_summary(df).first()
    assert (counts.valid, counts.invalid, counts.size_corrected) == (len(GOOD_ROWS), len(BAD), 1)
    write_checked(checked(df), folder)
    split = {r.valid: r["count"] for r in spark.read.parquet(folder).groupBy(F.col("valid").cast("boolean").alias("valid")).count().collect()}
    assert split == {True: len(GOOD_ROWS), False: len(BAD)}
