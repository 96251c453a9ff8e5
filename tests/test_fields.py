"""Column functions on hand-made values."""

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.functions import metadata as fm
from mediacat.functions import objects as fo
from mediacat.functions.hits import parse_hits
from mediacat.plans import batch_metadata
from mediacat.schemas import RAW_METADATA


def values(spark, inputs, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_video_extensions(spark):
    keys = ["a.MP4", "a.ts", "a.mp4\n", "mp4", ".mov", "a.mp4.txt", "", None]
    assert values(spark, keys, fo.is_video) == [True, True, False, False, True, False, False, None]


def test_content_type_has_seven_of_nine_extensions(spark):
    keys = ["a.MOV", "a.flv", "a.m4v", "mp4", "x.tar.webm", "a.", "dir.mp4/file"]
    octet = "application/octet-stream"
    expected = ["video/quicktime", octet, octet, octet, "video/webm", octet, octet]
    assert values(spark, keys, fo.content_type) == expected


def test_etag_loses_all_outer_quotes(spark):
    assert values(spark, ['"abc"', '""a"b""', '"', "a"], fo.clean_etag) == ["abc", 'a"b', "", "a"]


def test_strip_knows_unicode_blanks(spark):
    assert values(spark, [" a b \n", "\t", "a"], fo.strip_blanks) == ["a b", "", "a"]


def test_uri_parts(spark):
    uris = ["s3://b/k/l", "s3://b", "s3://b/", "http://b/k", "s3:///k", "s3://b/k\nl"]
    parts = values(spark, uris, fo.split_uri)
    assert [tuple(p) if p else None for p in parts] == [
        ("b", "k/l"), ("b", ""), ("b", ""), None, ("", "k"), ("b", "k\nl"),
    ]


def test_size_rounds_ties_to_even_or_up(spark):
    ties = [131072, 3 * 131072, 0]
    assert values(spark, ties, fo.size_mb, "long") == [0.12, 0.38, 0.0]
    assert values(spark, ties, lambda c: fo.size_mb(c, half_even=False), "long") == [0.13, 0.38, 0.0]


def test_derived_ids(spark):
    rows = [(None, "s3://b/k", "k"), ("", None, "k"), ("", "", "k"), ("x", "s3://b/k", "k"), (None, None, None), (" ", "u", "k")]
    df = spark.createDataFrame(rows, "id string, uri string, key string")
    got = [r[0] for r in df.select(fo.derive_video_id(F.col("id"), F.col("uri"), F.col("key"))).collect()]

    def derived(text):
        return "derived_" + hashlib.sha256(text.encode()).hexdigest()[:16]

    assert got == [derived("s3://b/k"), derived("k"), derived("k"), "x", derived(""), " "]


def test_times_that_do_not_parse_are_null(spark):
    got = values(spark, ["2024-01-15T10:23:00Z", "2024-01-15 10:23:00", "n/a", None], lambda c: F.unix_timestamp(fm.parse_time(c)))
    assert got[0] == got[1] == 1705314180 and got[2:] == [None, None]


def test_resolution_skips_missing_sides(spark):
    df = spark.createDataFrame([(1920, 1080), (None, 720), (640, None), (None, None)], "w int, h int")
    loose = [r[0] for r in df.select(fm.resolution(F.col("w"), F.col("h"))).collect()]
    strict = [r[0] for r in df.select(fm.resolution(F.col("w"), F.col("h"), strict=True)).collect()]
    assert loose == ["1920x1080", "720", "640", ""] and strict == ["1920x1080", None, None, None]


def test_status_words(spark):
    words = ["ready", "failed", "timeout", "indexed", "embedded", "upload_failed", None, "odd"]
    assert values(spark, words, fm.status_normalized) == ["indexed", "failed", "failed"] + ["pending"] * 5
    full = values(spark, words, lambda c: fm.status_normalized(c, "full"))
    assert full == ["indexed", "failed", "failed", "indexed", "embedded", "failed", "pending", "pending"]
    with pytest.raises(ValueError):
        fm.status_normalized(F.lit("x"), "other")


def test_tags_from_list_or_map(spark):
    texts = ['["a", "b", "a"]', '{"k": "v"}', "nonsense", None]
    assert values(spark, texts, fm.tags_map) == [{"a": "", "b": ""}, {"k": "v"}, {}, {}]


def test_compact_json_is_recursive_but_spares_lists(spark):
    schema = T.StructType.fromDDL(
        "a string, b struct<c:int,d:timestamp>, m map<string,string>, l array<string>, s array<struct<x:int,y:int>>"
    )
    at = datetime(2024, 1, 15, 10, 23, 0, 500, tzinfo=timezone.utc)
    rows = [
        (None, (None, at), {"k": None, "v": "1"}, ["x", None], [(1, None), None]),
        ("a", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(fm.compact_json(schema)).collect()]
    assert got == [
        '{"b":{"d":"2024-01-15T10:23:00.000500+00:00"},"m":{"v":"1"},"l":["x",null],"s":[{"x":1},null]}',
        '{"a":"a"}',
    ]


def test_hits_of_odd_responses(spark):
    responses = [
        '{"data":[{"video_id":"v","score":1,"start":1e1,"end":2.25,"thumbnail_url":"t"},null,[1],"s",{}]}',
        '{"data":{"video_id":"v"}}',
        "[]",
        "{",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(responses)), "id int, response string")
    got = [tuple(r) for r in parse_hits(df, "response").orderBy("id", "position").collect()]
    assert got == [(0, 0, "v", 1.0, 10.0, 2.25, "", "t"), (0, 4, "", 0.0, 0.0, 0.0, "", "")]


def raw(**fields):
    return tuple(fields.get(name) for name in RAW_METADATA.names)


def test_batch_sample_row(spark):
    rows = [
        raw(video_id="v1", status="embedded", created_at="2024-01-15T10:23:00Z", indexed_at="2024-01-15T10:31:44Z", file_size_bytes=131072),
        raw(video_id="", status="ready"),
        raw(video_id=None),
        raw(video_id="v2", status="ready", created_at="2024-01-15T10:23:00Z", indexed_at="2024-01-15T10:22:00Z"),
    ]
    out = batch_metadata.transform(spark.createDataFrame(rows, RAW_METADATA)).orderBy("video_id").collect()
    assert [(r.video_id, r.indexing_latency_sec, r.status_normalized) for r in out] == [
        ("v1", 524, "pending"), ("v2", -60, "indexed"),
    ]
    assert out[0].file_size_mb == 0.13
    assert not {"created_at", "indexed_at", "width", "height", "file_size_bytes"} & set(out[0].asDict())


def test_null_columns_are_dropped(spark):
    rows = [raw(video_id="v1", status="ready"), raw(video_id="v2", fps=24.0)]
    kept = batch_metadata.drop_null_columns(spark.createDataFrame(rows, RAW_METADATA))
    assert kept.columns == ["video_id", "status", "fps"]
