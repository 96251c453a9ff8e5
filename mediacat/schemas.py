"""Fixed vocabularies and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# File extensions that count as video.
VIDEO_EXTENSIONS = (".mp4", ".mov", ".avi", ".mkv", ".webm", ".flv", ".m4v", ".ts", ".wmv")

# Extension to content type; every other extension gets the default.
CONTENT_TYPES = {
    "mp4": "video/mp4",
    "mov": "video/quicktime",
    "avi": "video/x-msvideo",
    "mkv": "video/x-matroska",
    "webm": "video/webm",
    "ts": "video/mp2t",
    "wmv": "video/x-ms-wmv",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"

# Status words.
STATUSES = ("pending", "indexing", "indexed", "embedding", "embedded", "failed", "skipped")
EMBEDDING_STATUSES = ("pending", "embedded", "embedding_failed", "skipped")
TERMINAL_TASK_STATUSES = ("ready", "failed")
OPEN_TASK_STATUSES = ("pending", "indexing")
SUCCESS_STATUSES = ("embedded", "indexed")

# Defaults, limits and time-outs.
BYTES_PER_MB = 1_048_576
SIZE_TOLERANCE_MB = 0.1
DEFAULT_SOURCE = "s3-ingest"
INDEX_DEADLINE_SEC = 1200
SEARCH_LIMIT, SEARCH_LIMIT_MAX = 10, 50
LIST_LIMIT, LIST_LIMIT_MAX = 20, 100
PAGE_SIZE = 50
MODALITIES = ("visual", "conversation", "text_in_video", "logo")
DEFAULT_MODALITIES = ("visual", "conversation")

# Retention rules as (bucket role, key prefix, days, action).
RETENTION_RULES = (
    ("raw", "raw/", 30, "STANDARD_IA"),
    ("raw", "raw/", 180, "GLACIER"),
    ("raw", "manifests/processed/", 7, "EXPIRE"),
    ("embeddings", "embeddings/", 90, "STANDARD_IA"),
    ("manifests", "manifests/pending/", 1, "EXPIRE"),
)

# The characters that count as blank when ids and keys are trimmed.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_S, _L, _I, _D, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
_TAGS = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


RAW_METADATA = _struct(
    video_id=_S, s3_key=_S, index_id=_S, status=_S, duration_sec=_D, file_size_bytes=_L, width=_I, height=_I,
    fps=_D, created_at=_S, indexed_at=_S, embedding_s3=_S, source=_S, tags=_S,
)

OBJECT_LISTING = _struct(
    bucket=_S, s3_key=_S, size_bytes=_L, last_modified=_TS, etag=_S,
)

VIDEO = _struct(
    video_id=_S, s3_key=_S, s3_uri=_S, index_id=_S, status=_S, embedding_status=_S, size_bytes=_L, size_mb=_D,
    content_type=_S, etag=_S, last_modified=_TS, created_at=_TS, indexed_at=_TS, embedded_at=_TS, duration_sec=_D,
    resolution=_S, fps=_D, source=_S, tags=_TAGS, embedding_s3=_S,
)

TASK_EVENTS = _struct(task_id=_S, video_id=_S, status=_S, ts=_TS)

REQUIRED = ("video_id", "s3_key", "s3_uri", "index_id", "size_bytes", "size_mb", "last_modified")
NON_NEGATIVE = ("size_bytes", "size_mb", "duration_sec", "fps")
