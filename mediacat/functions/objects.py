"""Column functions over object listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediacat.schemas import BLANKS, BYTES_PER_MB, CONTENT_TYPES, DEFAULT_CONTENT_TYPE, VIDEO_EXTENSIONS


def is_video(key: Column) -> Column:
    """Key ends with a video extension, in any case."""
    lowered = F.lower(key)
    return reduce(Column.__or__, [lowered.endswith(extension) for extension in VIDEO_EXTENSIONS])


def content_type(key: Column) -> Column:
    """Content type by the text after the last dot."""
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    extension = F.lower(F.substring_index(key, ".", -1))
    found = F.when(key.contains("."), F.try_element_at(known, extension))
    return F.coalesce(found, F.lit(DEFAULT_CONTENT_TYPE))


def clean_etag(etag: Column) -> Column:
    """Strip the double quotes around an etag."""
    return F.btrim(etag, F.lit('"'))


def strip_blanks(text: Column) -> Column:
    """Trim every Unicode blank; plain `trim` only knows the space."""
    return F.btrim(text, F.lit(BLANKS))


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def split_uri(uri: Column) -> Column:
    """Struct (bucket, key) of an object URI, null for any other scheme."""
    path = F.substr(uri, F.lit(6))
    bucket = F.substring_index(path, "/", 1)
    key = F.substr(path, F.length(bucket) + 2)
    return F.when(uri.startswith("s3://"), F.struct(bucket.alias("bucket"), key.alias("key")))


def size_mb(size_bytes: Column, half_even: bool = True) -> Column:
    """Megabytes with two decimals; the catalogue rounds ties to even, the batch job rounds them up."""
    exact = size_bytes / F.lit(BYTES_PER_MB)
    return F.bround(exact, 2) if half_even else F.round(exact, 2)


def derive_video_id(video_id: Column, uri: Column, key: Column) -> Column:
    """Given id, or a stable id hashed from the URI (else the key) when it is missing or empty."""
    seed = F.coalesce(F.nullif(uri, F.lit("")), key, F.lit(""))
    derived = F.concat(F.lit("derived_"), F.substr(F.sha2(seed, 256), F.lit(1), F.lit(16)))
    return F.coalesce(F.nullif(video_id, F.lit("")), derived)
