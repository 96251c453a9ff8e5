"""Sources and sinks on small files."""

import io
import json
import os
import time
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import functions as F

from mediacat.plans import batch_metadata
from mediacat.schemas import RAW_METADATA, VIDEO
from mediacat.sources import manifests, vectors
from mediacat.sources import objects as so
from mediacat.sources.metadata import read_raw_metadata, read_raw_rejects, write_partition


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def test_raw_metadata_documents(spark, folder):
    put(f"{folder}/a.json", json.dumps([{"video_id": "v1", "tags": ["x", "y"], "width": 5}, {"video_id": "v2", "tags": {"k": 1}}], indent=2))
    put(f"{folder}/b.json", '{"video_id": "v3", "other": 1}')
    put(f"{folder}/c.json", '{"video_id": "broken')
    df = read_raw_metadata(spark, folder)
    assert df.schema == RAW_METADATA
    rows = {r.video_id: r for r in df.collect()}
    assert set(rows) == {"v1", "v2", "v3", None}
    assert json.loads(rows["v1"].tags) == ["x", "y"] and json.loads(rows["v2"].tags) == {"k": 1}
    assert batch_metadata.transform(df).count() == 3
    rejects = read_raw_rejects(spark, folder).collect()
    assert [(r.path[-6:], r.text) for r in rejects] == [("c.json", '{"video_id": "broken')]


def test_partition_rerun_keeps_other_dates(spark, folder):
    day = spark.createDataFrame([("a",), ("b",)], "video_id string")
    for dt, df in (("2024-01-01", day), ("2024-01-02", day), ("2024-01-02", day.limit(1))):
        write_partition(df, folder, dt)
    got = spark.read.parquet(folder).groupBy("dt").count().collect()
    assert {str(r.dt): r["count"] for r in got} == {"2024-01-01": 2, "2024-01-02": 1}


def test_batch_run_counts(spark, folder):
    put(f"{folder}/in/a.json", json.dumps([{"video_id": "v1", "status": "ready"}, {"video_id": ""}, {"s3_key": "k"}]))
    assert batch_metadata.run(spark, f"{folder}/in", f"{folder}/out", "2024-01-15") == {"read": 3, "written": 1}
    batch_metadata.run(spark, f"{folder}/in", f"{folder}/slim", "2024-01-15", drop_empty=True)
    assert set(spark.read.parquet(f"{folder}/slim").columns) == {
        "video_id", "status", "resolution", "has_embedding", "status_normalized", "dt",
    }


def test_list_files_reads_no_content(spark, folder):
    put(f"{folder}/raw/x/a.mp4", b"12345")
    put(f"{folder}/raw/b.txt", b"1")
    listed = so.list_files(spark, folder, "bkt")
    assert {(r.s3_key, r.size_bytes) for r in listed.collect()} == {("raw/x/a.mp4", 5), ("raw/b.txt", 1)}
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    video = so.list_objects(listed).first()
    assert (video.s3_uri, video.content_type, video.size_mb) == ("s3://bkt/raw/x/a.mp4", "video/mp4", 0.0)
    os.utime(f"{folder}/raw/b.txt", (0, 0))
    assert so.list_files(spark, folder, "bkt", modified_after="2001-01-01T00:00:00").count() == 1
    assert so.list_files(spark, f"file:{folder}/", "bkt").filter("s3_key = 'raw/b.txt'").count() == 1


def listing(spark, rows):
    return spark.createDataFrame(rows, "bucket string, s3_key string, size_bytes long, last_modified timestamp, etag string")


def test_watermark_is_strict_and_naive_times_are_utc(spark):
    at = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
    df = listing(spark, [("b", "old.mp4", 1, at, "e"), ("b", "new.mp4", 1, at.replace(microsecond=1), "e")])
    for watermark in (at, at.replace(tzinfo=None), "2024-01-01T12:00:00Z"):
        assert [r.s3_key for r in so.list_objects_since(df, watermark).collect()] == ["new.mp4"]


def test_select_keys_keeps_order_repeats_and_any_type(spark):
    df = listing(spark, [("b", k, 1, None, '"e"') for k in ("a.mp4", "b.txt", "c.mp4")])
    wanted = spark.createDataFrame(list(enumerate(["c.mp4", "none", "b.txt", "c.mp4"])), "pos int, s3_key string")
    assert [r.s3_key for r in so.select_keys(df, wanted).collect()] == ["c.mp4", "b.txt", "c.mp4"]
    assert [r.s3_key for r in so.missing_keys(df, wanted).collect()] == ["none"]


def test_tags_of_a_hot_object_collapse(spark):
    objects = spark.createDataFrame([("hot",), ("cold",)], "s3_key string")
    tags = spark.range(5000).select(
        F.lit("hot").alias("s3_key"), F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("tag"),
        F.col("id").cast("string").alias("value"), F.col("id").alias("seq"),
    )
    tags = tags.unionByName(tags.limit(1).withColumn("tag", F.lit(None).cast("string")))
    got = {r.s3_key: r.tags for r in so.attach_tags(objects, tags).collect()}
    assert got == {"hot": {"t0": "4998", "t1": "4999", "t2": "4997"}, "cold": {}}


def test_oldest_manifest_first(spark, folder):
    os.makedirs(folder)
    assert manifests.read_manifests(spark, folder).count() == 0
    for name, age in (("new.json", 10), ("old.json", 1000)):
        put(f"{folder}/{name}", json.dumps([{"s3_key": f"{name}-{i}", "size_bytes": i} for i in range(60)], indent=2))
        os.utime(f"{folder}/{name}", (time.time() - age,) * 2)
    rows = manifests.read_manifests(spark, folder).collect()
    assert [r.s3_key for r in rows] == [f"old.json-{i}" for i in range(60)]
    assert rows[0].presigned_url is None


def test_written_manifest_is_read_back_in_order(spark, folder):
    at = datetime(2024, 1, 1, 5, tzinfo=timezone.utc)
    rows = [(f"k{i:03}", at if i % 2 else None, {"a": None, "b": "1"}) for i in range(200)]
    df = spark.createDataFrame(rows, "s3_key string, created_at timestamp, tags map<string,string>").repartition(5)
    path = manifests.write_manifest(df, folder, "run")
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(files) >= 1
    lines = [json.loads(line) for f in files for line in open(f"{path}/{f}")]
    assert sorted(lines, key=lambda r: r["s3_key"])[:2] == [
        {"s3_key": "k000", "tags": {"b": "1"}},
        {"s3_key": "k001", "created_at": "2024-01-01T05:00:00+00:00", "tags": {"b": "1"}},
    ]
    got = manifests.read_manifests(spark, folder, 50).collect()
    assert [r.s3_key for r in got] == [f"k{i:03}" for i in range(50)]
    assert manifests.default_run_id(at) == "20240101T050000Z"


def test_vector_files_and_table(spark, folder):
    for name, values in (("v1", [1.5, 2.5]), ("x/v2", [3.0])):
        buffer = io.BytesIO()
        np.save(buffer, np.array(values, dtype=np.float32))
        put(f"{folder}/npy/{name}.npy", buffer.getvalue())
    read = vectors.read_vectors(spark, f"{folder}/npy")
    assert {(r.video_id, tuple(r.embedding)) for r in read.collect()} == {("v1", (1.5, 2.5)), ("v2", (3.0,))}
    wanted = spark.createDataFrame([("v1",), ("v9",), ("v9",)], "video_id string")
    assert [r.video_id for r in vectors.missing_vectors(read, wanted).collect()] == ["v9"]
    vectors.write_vectors(read, f"{folder}/table", "m1")
    vectors.write_vectors(read.limit(1), f"{folder}/table", "m2")
    vectors.write_vectors(read.limit(1), f"{folder}/table", "m2", mode="overwrite")
    assert vectors.read_vector_table(spark, f"{folder}/table", "m1").count() == 2
    assert spark.read.parquet(f"{folder}/table").count() == 3
    row = vectors.read_vector_table(spark, f"{folder}/table", "m1").filter("video_id = 'v2'").first()
    assert (row.vector_dim, row.embedding_s3) == (1, "embeddings/v2.npy")


def test_manifest_schema_follows_the_catalogue():
    assert [f for f in VIDEO.names if f not in manifests.MANIFEST.names] == []
