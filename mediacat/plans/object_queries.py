"""Queries over object listings: listing, keys, tags, validation, retention, manifests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.functions import objects as fo
from mediacat.functions.metadata import compact_json
from mediacat.operators import reports, retention, tasks
from mediacat.operators.validate import checked, coerce, enrich, validate, validation_summary
from mediacat.plans import views
from mediacat.plans.registry import query
from mediacat.plans.views import time_text, with_views
from mediacat.session import run_dir
from mediacat.sources import manifests
from mediacat.sources import objects as so
from mediacat.sources.listing_source import ObjectListing

NOW = "2024-12-31 00:00:00"

_VIDEO_KEY = """(lower(s3_key) LIKE '%.mp4' OR lower(s3_key) LIKE '%.mov' OR lower(s3_key) LIKE '%.avi'
    OR lower(s3_key) LIKE '%.mkv' OR lower(s3_key) LIKE '%.webm' OR lower(s3_key) LIKE '%.flv'
    OR lower(s3_key) LIKE '%.m4v' OR lower(s3_key) LIKE '%.ts' OR lower(s3_key) LIKE '%.wmv')"""

_CONTENT_TYPE = """CASE WHEN s3_key NOT LIKE '%.%' THEN 'application/octet-stream'
    ELSE CASE lower(regexp_extract(s3_key, '[^.]*$')) WHEN 'mp4' THEN 'video/mp4' WHEN 'mov' THEN 'video/quicktime'
    WHEN 'avi' THEN 'video/x-msvideo' WHEN 'mkv' THEN 'video/x-matroska' WHEN 'webm' THEN 'video/webm'
    WHEN 'ts' THEN 'video/mp2t' WHEN 'wmv' THEN 'video/x-ms-wmv' ELSE 'application/octet-stream' END END"""

_DESCRIBED = f"""bucket, s3_key, 's3://' || bucket || '/' || s3_key AS s3_uri, size_bytes,
    round_even(size_bytes / 1048576, 2) AS size_mb, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified,
    trim(etag, '"') AS etag, {_CONTENT_TYPE} AS content_type"""


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("last_modified", time_text("last_modified"))


@query("S2", "P1", "P2", "P3", "P4", "P5", sql=with_views(f"SELECT {_DESCRIBED} FROM objects WHERE {_VIDEO_KEY}", "objects"))
def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(so.list_objects(views.objects(spark, sf_dir), "raw/"))


@query(
    "S3",
    sql=with_views(
        f"SELECT {_DESCRIBED} FROM objects WHERE {_VIDEO_KEY} AND last_modified > TIMESTAMP '2024-01-01 06:00:00'", "objects"
    ),
)
def objects_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(so.list_objects_since(views.objects(spark, sf_dir), datetime(2024, 1, 1, 6)))


@query(
    "S2",
    sql="""SELECT 'source=' || source || '/lang=' || lang AS folder, 'video/mp2t' AS content_type, true AS filled
        FROM documents GROUP BY ALL""",
)
def list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that Spark has written, listed without reading them."""
    folder = run_dir(spark, "files")
    rows = views.table(spark, sf_dir, "documents").select("source", "lang", "text")
    rows.write.partitionBy("source", "lang").parquet(f"{folder}/clips.ts")
    listed = so.list_files(spark, folder, "raw")
    inside = F.concat(F.regexp_extract("s3_key", r"^clips\.ts/(.*)/[^/]*$", 1), F.lit(".ts"))
    named = so.list_objects(listed.withColumn("s3_key", inside))
    by_folder = named.groupBy(F.regexp_replace("s3_key", r"\.ts$", "").alias("folder"), "content_type")
    return by_folder.agg((F.sum("size_bytes") > 0).alias("filled"))


@query(
    "S2",
    sql="""SELECT 'source=' || source || '/lang=' || lang AS folder, 'video/mp2t' AS content_type, true AS filled
        FROM documents GROUP BY ALL""",
)
def list_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, listed by tasks: one partition per folder below the root."""
    folder = run_dir(spark, "prefixes")
    rows = views.table(spark, sf_dir, "documents").select("source", "lang", "text")
    rows.write.partitionBy("source", "lang").parquet(folder)
    spark.dataSource.register(ObjectListing)
    listed = spark.read.format("object_listing").options(root=folder, bucket="raw").load()
    inside = F.concat(F.regexp_extract("s3_key", r"^(.*)/[^/]*$", 1), F.lit(".ts"))
    named = so.list_objects(listed.withColumn("s3_key", inside))
    by_folder = named.groupBy(F.regexp_replace("s3_key", r"\.ts$", "").alias("folder"), "content_type")
    return by_folder.agg((F.sum("size_bytes") > 0).alias("filled"))


def _requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for every labelled document; the toxic ones are asked for by a key that does not exist."""
    labels = views.table(spark, sf_dir, "labels")
    known = views.objects(spark, sf_dir).select("doc_id", "s3_key")
    key = F.when(F.col("toxic") == 1, F.concat(F.lit("gone/"), F.col("doc_id").cast("string"))).otherwise(F.col("s3_key"))
    return labels.join(known, "doc_id").select(F.col("doc_id").alias("pos"), key.alias("s3_key"))


_REQUESTED = """requested AS (SELECT doc_id AS pos, CASE WHEN toxic = 1 THEN 'gone/' || doc_id ELSE s3_key END AS s3_key
    FROM labels JOIN objects USING (doc_id))"""


@query(
    "S4", "Q7",
    sql=with_views(f"SELECT pos, {_DESCRIBED} FROM requested JOIN objects USING (s3_key)", "objects", ctes=_REQUESTED),
)
def select_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(so.select_keys(views.objects(spark, sf_dir), _requested(spark, sf_dir)))


@query(
    "S4", "J3",
    sql=with_views("SELECT * FROM requested WHERE s3_key NOT IN (SELECT s3_key FROM objects)", "objects", ctes=_REQUESTED),
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return so.missing_keys(views.objects(spark, sf_dir), _requested(spark, sf_dir))


@query(
    "A5",
    sql=with_views(
        """SELECT count(*) AS requested, count(*) FILTER (s3_key IN (SELECT s3_key FROM objects)) AS found
        FROM requested""",
        "objects",
        ctes=_REQUESTED,
    ),
)
def requested_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.requested_found(_requested(spark, sf_dir), views.objects(spark, sf_dir))


@query(
    "S5",
    sql=with_views(
        """SELECT s3_key, coalesce(quality::VARCHAR, '') AS quality, coalesce(toxic::VARCHAR, '') AS toxic,
        (CASE WHEN quality IS NULL THEN 0 ELSE 2 END)::INTEGER AS tags FROM objects LEFT JOIN labels USING (doc_id)""",
        "objects",
    ),
)
def attach_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity labels as object tags; the first delivery of each tag is overwritten by a second one."""
    found = views.objects(spark, sf_dir)
    labels = views.table(spark, sf_dir, "labels").join(found.select("doc_id", "s3_key"), "doc_id")
    pairs = [
        F.struct(F.lit(tag).alias("tag"), value.alias("value"), F.lit(seq).alias("seq"))
        for tag in ("quality", "toxic")
        for seq, value in ((1, F.lit("old")), (2, F.col(tag).cast("string")))
    ]
    tags = labels.select("s3_key", F.inline(F.array(*pairs)))
    tagged = so.attach_tags(found.select("s3_key"), tags)
    return tagged.select(
        "s3_key",
        F.coalesce(F.try_element_at("tags", F.lit("quality")), F.lit("")).alias("quality"),
        F.coalesce(F.try_element_at("tags", F.lit("toxic")), F.lit("")).alias("toxic"),
        F.size("tags").alias("tags"),
    )


@query(
    "P1", "P2",
    sql=with_views(f"SELECT s3_key, {_VIDEO_KEY} AS is_video, {_CONTENT_TYPE} AS content_type FROM objects", "objects"),
)
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s3_key")
    return views.objects(spark, sf_dir).select(
        "s3_key", fo.is_video(key).alias("is_video"), fo.content_type(key).alias("content_type")
    )


@query(
    "P4",
    sql=with_views(
        """SELECT s3_uri, CASE WHEN s3_uri LIKE 's3://%' THEN split_part(substr(s3_uri, 6), '/', 1) END AS uri_bucket,
        CASE WHEN s3_uri LIKE 's3://%' THEN substr(s3_uri, 10) END AS uri_key,
        's3://' || bucket || '/' || s3_key AS built FROM objects""",
        "objects",
    ),
)
def object_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = fo.split_uri(F.col("s3_uri"))
    return views.objects(spark, sf_dir).select(
        "s3_uri",
        parts["bucket"].alias("uri_bucket"),
        parts["key"].alias("uri_key"),
        fo.object_uri(F.col("bucket"), F.col("s3_key")).alias("built"),
    )


_ENRICHED = """enriched AS (SELECT doc_id, bucket, s3_key, s3_uri, etag, last_modified, size_bytes, resolution, index_id,
    CASE WHEN coalesce(video_id, '') = '' THEN 'derived_' || substr(sha256(s3_uri), 1, 16) ELSE video_id END AS video_id,
    coalesce(status, 'pending') AS status, coalesce(size_mb, round_even(size_bytes / 1048576, 2)) AS size_mb
    FROM objects)"""

_CHECKED = """checked AS (SELECT *, list_filter([CASE WHEN status = 'ready' THEN 'bad:status' END,
    CASE WHEN s3_uri NOT LIKE 's3://%' THEN 'bad:s3_uri' END,
    CASE WHEN resolution = 'bad' THEN 'bad:resolution' END], lambda x: x IS NOT NULL) AS errors,
    abs(round_even(size_bytes / 1048576, 2) - size_mb) > 0.1 AS size_corrected FROM enriched)"""

_RULES = f"{_ENRICHED}, {_CHECKED}"


def _now() -> object:
    return F.lit(NOW).cast("timestamp")


@query(
    "P6", "P7", "P8",
    sql=with_views(
        """SELECT doc_id, video_id, index_id, status, 's3-ingest' AS source, 'pending' AS embedding_status, size_mb,
        '2024-12-31 00:00:00' AS created_at FROM enriched""",
        "objects",
        ctes=_ENRICHED,
    ),
)
def derive_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich(coerce(views.objects(spark, sf_dir)), "idx_default", _now())
    shown = ("doc_id", "video_id", "index_id", "status", "source", "embedding_status", "size_mb")
    return rows.select(*shown, time_text("created_at").alias("created_at"))


@query(
    "D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8", "D9", "P8",
    sql=with_views(
        """SELECT doc_id, trim(video_id) AS video_id, s3_key, s3_uri, index_id, status, size_bytes,
        CASE WHEN size_corrected THEN round_even(size_bytes / 1048576, 2) ELSE size_mb END AS size_mb,
        resolution, size_corrected, 'video/mp4' AS content_type,
        strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified FROM checked WHERE len(errors) = 0""",
        "objects",
        ctes=_RULES,
    ),
)
def validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = validate(views.objects(spark, sf_dir), now=_now())
    columns = ["doc_id", "video_id", "s3_key", "s3_uri", "index_id", "status", "size_bytes", "size_mb", "resolution"]
    return valid.select(*columns, "size_corrected", "content_type", time_text("last_modified").alias("last_modified"))


@query(
    "D2", "D6", "D7",
    sql=with_views(
        "SELECT doc_id, array_to_string(errors, ',') AS errors FROM checked WHERE len(errors) > 0", "objects", ctes=_RULES
    ),
)
def validate_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = validate(views.objects(spark, sf_dir), now=_now())
    return rejects.select("doc_id", F.array_join("errors", ",").alias("errors"))


@query(
    "D1", "D4", "D5", "D8",
    sql="""WITH given AS (SELECT event_id, CASE event_type WHEN 'click' THEN '/events/' WHEN 'view' THEN ''
            ELSE 'events/' END || CASE event_type WHEN 'view' THEN '' ELSE event_id::VARCHAR END AS s3_key, value, event_type
            FROM events),
        coded AS (SELECT event_id, event_type, list_filter([
            CASE WHEN value % 1 <> 0 THEN 'type:size_bytes' END,
            CASE WHEN event_type = 'error' THEN 'missing:index_id' END,
            CASE WHEN value % 1 <> 0 THEN 'missing:size_mb' END,
            CASE WHEN event_type IN ('click', 'view') THEN 'bad:s3_key' END,
            CASE WHEN event_type = 'signup' THEN 'negative:duration_sec' END], lambda x: x IS NOT NULL) AS errors FROM given)
        SELECT event_id, array_to_string(errors, ',') AS errors FROM coded""",
)
def validate_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All errors of each row, on events dressed up as records with text sizes, bad keys and negative durations."""
    kind = F.col("event_type")
    key = F.when(kind == "view", "").when(kind == "click", F.concat(F.lit("/events/"), F.col("event_id").cast("string")))
    rows = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("video_id"),
        key.otherwise(F.concat(F.lit("events/"), F.col("event_id").cast("string"))).alias("s3_key"),
        F.lit("s3://raw/events").alias("s3_uri"),
        F.when(kind != "error", "idx_0").alias("index_id"),
        F.col("value").cast("string").alias("size_bytes"),
        F.col("ts").cast("timestamp").alias("last_modified"),
        F.when(kind == "signup", -1.0).otherwise(F.col("value")).alias("duration_sec"),
    )
    valid, rejects = validate(rows, now=_now())
    codes = rejects.select("event_id", F.array_join("errors", ",").alias("errors"))
    return codes.unionByName(valid.select("event_id", F.lit("").alias("errors")))


@query(
    "D3", "D4", "P8",
    sql="""SELECT event_id, 'video/mp4' AS content_type, array_to_string(list_filter([
            CASE WHEN event_id % 4 = 3 THEN 'bad:embedding_status' END,
            CASE WHEN event_id % 7 = 0 THEN 'negative:size_bytes' END, CASE WHEN event_id % 5 < 2 THEN 'negative:size_mb' END,
            CASE WHEN event_id % 3 < 2 THEN 'negative:duration_sec' END, CASE WHEN event_id % 11 < 2 THEN 'negative:fps' END],
        lambda x: x IS NOT NULL), ',') AS errors FROM events""",
)
def validate_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative numbers and NaN in every column that must not be negative, and unknown embedding statuses, on events."""
    n, nan = F.col("event_id"), F.lit(float("nan"))
    name = n.cast("string")
    states = F.when(n % 4 == 0, "pending").when(n % 4 == 1, "embedding_failed").when(n % 4 == 2, "skipped")
    rows = views.table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit("v"), name).alias("video_id"),
        F.concat(F.lit("events/"), name).alias("s3_key"),
        F.lit("s3://raw/events").alias("s3_uri"),
        F.lit("idx_0").alias("index_id"),
        F.col("ts").cast("timestamp").alias("last_modified"),
        F.when(n % 7 == 0, -n - 1).otherwise(n).alias("size_bytes"),
        F.when(n % 5 == 0, nan).when(n % 5 == 1, -0.5).otherwise(1.0).alias("size_mb"),
        F.when(n % 3 == 0, nan).when(n % 3 == 1, -1.0).otherwise(F.col("value")).alias("duration_sec"),
        F.when(n % 11 == 0, -30.0).when(n % 11 == 1, nan).otherwise(24.0).alias("fps"),
        states.otherwise("odd").alias("embedding_status"),
        F.lit(" Video/MP4\t").alias("content_type"),
    )
    return checked(rows, now=_now()).select("event_id", "content_type", F.array_join("errors", ",").alias("errors"))


@query(
    "D9", "D10",
    sql=with_views(
        """SELECT count(*) FILTER (len(errors) = 0) AS valid, count(*) FILTER (len(errors) > 0) AS invalid,
        count(*) FILTER (len(errors) = 0 AND size_corrected) AS size_corrected FROM checked""",
        "objects",
        ctes=_RULES,
    ),
)
def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation_summary(views.objects(spark, sf_dir), now=_now())


@query(
    "P17",
    sql=with_views(
        """SELECT doc_id, '{"s3_key":"' || s3_key || '","last_modified":"' || strftime(last_modified, '%Y-%m-%dT%H:%M:%S')
        || '+00:00"' || CASE WHEN status IS NULL THEN '' ELSE ',"status":"' || status || '"' END || ',"file":{"size_bytes":'
        || size_bytes || CASE WHEN resolution IS NULL THEN '' ELSE ',"resolution":"' || resolution || '"' END
        || '},"tags":{"lang":"' || split_part(s3_key, '/', 3) || '"' || CASE WHEN status IS NULL THEN ''
        ELSE ',"state":"' || status || '"' END || '},"history":[' || CASE WHEN status IS NULL THEN 'null'
        ELSE '"' || status || '"' END || ']}' AS item FROM objects""",
        "objects",
    ),
)
def compact_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON without nulls in objects and maps; nulls inside lists stay."""
    shaped = views.objects(spark, sf_dir).select(
        "doc_id",
        "s3_key",
        "last_modified",
        "status",
        F.struct("size_bytes", "resolution").alias("file"),
        F.create_map(F.lit("lang"), F.split_part("s3_key", F.lit("/"), F.lit(3)), F.lit("state"), F.col("status")).alias("tags"),
        F.array("status").alias("history"),
    )
    record = shaped.drop("doc_id").schema
    return shaped.select("doc_id", compact_json(record).alias("item"))


_PLAN = """planned AS (SELECT bucket, s3_key, size_bytes, age_days, CASE WHEN age_days >= 180 THEN 'GLACIER'
    WHEN age_days >= 30 THEN 'STANDARD_IA' ELSE 'KEEP' END AS action FROM (SELECT *,
    floor((epoch(TIMESTAMP '2024-06-30 00:30:00') - epoch(last_modified)) / 86400)::BIGINT AS age_days FROM objects))"""

RETENTION_NOW = "2024-06-30 00:30:00"


@query("R1", sql=with_views("SELECT s3_key, age_days, action FROM planned", "objects", ctes=_PLAN))
def retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = retention.retention_plan(views.objects(spark, sf_dir), F.lit(RETENTION_NOW).cast("timestamp"))
    return plan.select("s3_key", "age_days", "action")


@query(
    "R1",
    sql=with_views(
        """SELECT bucket, action, count(*) AS objects, sum(size_bytes)::BIGINT AS bytes FROM planned
        GROUP BY bucket, action""",
        "objects",
        ctes=_PLAN,
    ),
)
def retention_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit(RETENTION_NOW).cast("timestamp")
    return retention.retention_bytes(retention.retention_plan(views.objects(spark, sf_dir), now))


@query(
    "A6",
    sql=with_views(
        """SELECT index_id, count(*) AS records, sum(octet_length(encode('{"s3_key":"' || s3_key || '","size_bytes":'
        || size_bytes || CASE WHEN status IS NULL THEN '' ELSE ',"status":"' || status || '"' END || '}')))::BIGINT AS bytes
        FROM objects GROUP BY index_id""",
        "objects",
    ),
)
def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.objects(spark, sf_dir).select("index_id", "s3_key", "size_bytes", "status")
    return reports.manifest_stats(rows, "index_id")


@query(
    "K7", "S6", "Q6",
    sql=with_views(
        """SELECT s3_key, trim(video_id) AS video_id, size_bytes, strftime(last_modified, '%Y-%m-%dT%H:%M:%S') || '+00:00'
        AS last_modified FROM checked WHERE len(errors) = 0 AND index_id = 'idx_0'""",
        "objects",
        ctes=_RULES,
    ),
)
def oldest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per index is written; the one written first is read."""
    folder = run_dir(spark, "manifests")
    valid, _ = validate(views.objects(spark, sf_dir), now=_now())
    for index in ("idx_0", "idx_1", "idx_2", "idx_3"):
        manifests.write_manifest(valid.filter(F.col("index_id") == index).drop("size_corrected"), folder, index)
    return manifests.read_manifests(spark, folder).select("s3_key", "video_id", "size_bytes", "last_modified")


@query(
    "K7", "S6",
    sql=with_views(
        "SELECT s3_key, status, size_bytes FROM checked WHERE len(errors) = 0", "objects", ctes=_RULES
    ),
)
def manifest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of a manifest, written and read back."""
    folder = run_dir(spark, "manifest")
    valid, _ = validate(views.objects(spark, sf_dir), now=_now())
    manifests.write_manifest(valid, folder, "all")
    return manifests.read_manifest(spark, manifests.oldest_manifest(spark, folder)).select("s3_key", "status", "size_bytes")
