"""Queries over the keyed catalogue and its updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.operators import paging
from mediacat.plans import views
from mediacat.plans.registry import query
from mediacat.plans.views import time_text, with_views
from mediacat.schemas import LIST_LIMIT, LIST_LIMIT_MAX
from mediacat.session import run_dir
from mediacat.sources.change_log import ChangeLog, put

NOW = "2024-12-31 00:00:00"
_T = "'%Y-%m-%d %H:%M:%S'"
_CATALOG = f"""video_id, index_id, status, embedding_status, strftime(created_at, {_T}) AS created_at, source"""


def _now() -> object:
    return F.lit(NOW).cast("timestamp")


def _shown(df: DataFrame) -> DataFrame:
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: time_text(c) for c in times}) if times else df


_LATEST = """latest AS (SELECT * FROM updates QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seq DESC) = 1)"""

_REPLACED = f"""SELECT {_CATALOG}, NULL::VARCHAR AS updated_at FROM catalog
    WHERE video_id NOT IN (SELECT video_id FROM updates)
    UNION ALL SELECT video_id, NULL, status, NULL, NULL, NULL, strftime(updated_at, {_T}) FROM latest"""


@query("J4", sql=with_views(f"SELECT video_id, status, strftime(updated_at, {_T}) AS updated_at, seq FROM latest", "updates", ctes=_LATEST))
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.latest_per_key(views.updates(spark, sf_dir), [F.desc("seq")]))


@query("K2", "K3", "J3", "J4", sql=with_views(_REPLACED, "catalog", "updates", ctes=_LATEST))
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.upsert_replace(views.catalog(spark, sf_dir), views.updates(spark, sf_dir), "seq"))


_FIRST_FINAL = """final AS (SELECT video_id, min(seq) AS final_seq FROM updates WHERE status = 'embedded' GROUP BY video_id)"""

_OUTCOMES = f"""{_FIRST_FINAL}, outcomes AS (SELECT updates.*, CASE
    WHEN video_id IN (SELECT video_id FROM catalog WHERE status = 'embedded') OR coalesce(seq > final_seq, false)
    THEN 'skipped' ELSE 'written' END AS outcome FROM updates LEFT JOIN final USING (video_id))"""

_GUARDED = f"""SELECT {_CATALOG}, NULL::VARCHAR AS updated_at FROM catalog
    WHERE video_id NOT IN (SELECT video_id FROM outcomes WHERE outcome = 'written')
    UNION ALL SELECT video_id, NULL, status, NULL, NULL, NULL, strftime(updated_at, {_T}) FROM outcomes
    WHERE outcome = 'written' QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seq DESC) = 1"""


@query("K2", "J3", sql=with_views(_GUARDED, "catalog", "updates", ctes=_OUTCOMES))
def upsert_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are `embedded`, or become so on the way, are not written again."""
    return _shown(oc.upsert_replace(views.catalog(spark, sf_dir), views.updates(spark, sf_dir), "seq", guard=True))


@query("K2", sql=with_views("SELECT video_id, seq, outcome FROM outcomes", "catalog", "updates", ctes=_OUTCOMES))
def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = oc.upsert_outcomes(views.catalog(spark, sf_dir), views.updates(spark, sf_dir), "seq", guard=True)
    return outcomes.select("video_id", "seq", "outcome")


@query(
    "K3", "A1",
    sql=with_views(
        """SELECT count(*) FILTER (coalesce(video_id, '') <> '') AS success, 0::BIGINT AS skipped,
        count(*) FILTER (coalesce(video_id, '') = '') AS failed, count(*) AS total FROM raw_metadata""",
        "raw_metadata",
    ),
)
def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a batch of which some rows have no key."""
    rows = views.raw_metadata(spark, sf_dir).withColumn("seq", F.col("s3_key"))
    return oc.upsert_summary(oc.upsert_outcomes(views.catalog(spark, sf_dir), rows, "seq"))


@query(
    "K4", "J5",
    sql=with_views(
        f"""SELECT coalesce(c.video_id, l.video_id) AS video_id, index_id,
        CASE WHEN l.video_id IS NOT NULL THEN l.status ELSE c.status END AS status, embedding_status,
        strftime(created_at, {_T}) AS created_at, source, strftime(updated_at, {_T}) AS updated_at, failed_at
        FROM catalog c FULL JOIN latest l ON c.video_id = l.video_id
        LEFT JOIN (SELECT video_id, strftime(arg_max(updated_at, seq), {_T}) AS failed_at FROM updates
            WHERE status = 'failed' GROUP BY video_id) f ON f.video_id = coalesce(c.video_id, l.video_id)""",
        "catalog",
        "updates",
        ctes=_LATEST,
    ),
)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and time are always set, null included; the time of failure only by failed updates."""
    changes = views.updates(spark, sf_dir).withColumn("failed_at", F.col("updated_at"))
    sets = {"status": None, "updated_at": None, "failed_at": F.coalesce(F.col("status") == "failed", F.lit(False))}
    return _shown(oc.upsert_merge(views.catalog(spark, sf_dir), changes, "seq", sets))


@query(
    "K4",
    sql=with_views(
        f"""SELECT coalesce(c.video_id, l.video_id) AS video_id, index_id,
        CASE WHEN l.video_id IS NOT NULL THEN l.status ELSE c.status END AS status, embedding_status,
        strftime(created_at, {_T}) AS created_at, source,
        CASE WHEN l.video_id IS NOT NULL THEN '{NOW}' END AS updated_at, seq
        FROM catalog c FULL JOIN latest l ON c.video_id = l.video_id""",
        "catalog",
        "updates",
        ctes=_LATEST,
    ),
)
def update_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = oc.update_status(views.catalog(spark, sf_dir), views.updates(spark, sf_dir), "seq", _now(), ["seq"])
    return _shown(rows)


def _deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The videos of customers with an order in state P."""
    orders = views.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return orders.select(
        F.concat(F.lit("idx_"), (F.col("o_custkey") % 4).cast("string")).alias("index_id"),
        F.concat(F.lit("v"), F.col("o_custkey").cast("string")).alias("video_id"),
    )


@query(
    "K11", "J3",
    sql=with_views(
        f"""SELECT {_CATALOG} FROM catalog WHERE (index_id, video_id) NOT IN
        (SELECT 'idx_' || (o_custkey % 4), 'v' || o_custkey FROM orders WHERE o_orderstatus = 'P')""",
        "catalog",
    ),
)
def delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.delete_rows(views.catalog(spark, sf_dir), _deleted(spark, sf_dir)))


@query("K11", sql=with_views(f"SELECT {_CATALOG} FROM catalog WHERE index_id <> 'idx_3'", "catalog"))
def delete_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.delete_index(views.catalog(spark, sf_dir), "idx_3"))


@query("Q1", sql=with_views(f"SELECT {_CATALOG} FROM catalog WHERE video_id = 'v42'", "catalog"))
def get_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(paging.get_video(views.catalog(spark, sf_dir), "v42", "idx_2"))


@query("Q2", sql=with_views(f"SELECT {_CATALOG} FROM catalog WHERE video_id > 'v1' ORDER BY video_id LIMIT 20", "catalog"))
def list_videos_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default page size, since 500 is out of range."""
    return _shown(paging.list_videos(views.catalog(spark, sf_dir), paging.clamp_limit(500, LIST_LIMIT, LIST_LIMIT_MAX), "v1"))


@query(
    "Q2", "A7",
    sql=with_views(
        """SELECT count(*) AS count, max(video_id) AS last_evaluated_key
        FROM (SELECT video_id FROM catalog ORDER BY video_id LIMIT 100)""",
        "catalog",
    ),
)
def list_videos_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page_info(paging.list_videos(views.catalog(spark, sf_dir), 100), 100)


@query(
    "Q2",
    sql=with_views(
        f"SELECT {_CATALOG} FROM catalog WHERE index_id = 'idx_1' ORDER BY video_id LIMIT 7 OFFSET 14", "catalog"
    ),
)
def list_index_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(paging.list_index_videos(views.catalog(spark, sf_dir), "idx_1", page=3, page_limit=7))


@query(
    "Q2", "Q3",
    sql="""SELECT event_id, user_id FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, event_id) AS n
        FROM events) WHERE n > 9000 AND n <= 12000""",
)
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page so deep that rows are ranked instead of being held in a top-n."""
    rows = views.table(spark, sf_dir, "events").select("user_id", "event_id")
    return paging.numbered_page(rows, ["user_id", "event_id"], page=4, page_limit=3000)


_TOTALS = f"""SELECT index_id, count(*) AS videos, count(*) FILTER (embedding_status = 'embedded') AS embedded,
    strftime(min(created_at), {_T}) AS first_created_at, strftime(max(created_at), {_T}) AS last_created_at
    FROM catalog GROUP BY index_id"""


@query("Q3", sql=with_views(_TOTALS, "catalog"))
def list_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(paging.list_indexes(views.catalog(spark, sf_dir)))


@query("Q3", sql=with_views(f"SELECT * FROM ({_TOTALS}) WHERE index_id = 'idx_2'", "catalog"))
def get_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(paging.get_index(views.catalog(spark, sf_dir), "idx_2"))


@query(
    "Q4",
    sql=with_views(
        f"SELECT {_CATALOG} FROM (SELECT * FROM catalog WHERE status = 'failed')",
        "catalog",
    ),
)
def get_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.by_status(views.catalog(spark, sf_dir), "failed"))


@query(
    "Q5",
    sql=with_views(
        f"""SELECT {_CATALOG} FROM (SELECT * FROM catalog WHERE status = 'ready' AND embedding_status = 'pending')""",
        "catalog",
    ),
)
def pending_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.pending_embedding(views.catalog(spark, sf_dir)))


@query(
    "Q4",
    sql=with_views(
        f"""SELECT {_CATALOG} FROM (SELECT * FROM catalog WHERE status = 'failed'
        ORDER BY created_at, video_id LIMIT 50 OFFSET 30)""",
        "catalog",
    ),
)
def next_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page of 50 after the first 30 failed videos, continued by key."""
    catalog = views.catalog(spark, sf_dir)
    last = oc.by_status(catalog, "failed", 30).orderBy(F.desc("created_at"), F.desc(oc.KEY)).first()
    return _shown(oc.by_status(catalog, "failed", 50, (last["created_at"], last[oc.KEY])))


def _task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.raw_metadata(spark, sf_dir).withColumn("task_id", F.concat(F.lit("task-"), "s3_key"))


_RESULT_ROWS = f"""results AS (SELECT CASE WHEN coalesce(video_id, '') = '' THEN 'no-id-' || s3_key ELSE video_id END AS video_id,
    s3_key, 'idx_9' AS index_id, status, 'task-' || s3_key AS task_id, '{NOW}' AS indexed_at,
    CASE WHEN status = 'ready' THEN 'pending' ELSE 'skipped' END AS embedding_status FROM raw_metadata)"""


@query("K5", sql=with_views("SELECT * FROM results", "raw_metadata", ctes=_RESULT_ROWS))
def task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(oc.task_result_rows(_task_results(spark, sf_dir), "idx_9", _now()))


@query(
    "K5", "K2",
    sql=with_views(
        f"""SELECT {_CATALOG}, NULL AS s3_key, NULL AS task_id, NULL AS indexed_at FROM catalog
        WHERE video_id NOT IN (SELECT video_id FROM results)
        UNION ALL SELECT video_id, index_id, status, embedding_status, NULL, NULL, s3_key, task_id, indexed_at FROM results""",
        "catalog",
        "raw_metadata",
        ctes=_RESULT_ROWS,
    ),
)
def write_task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _task_results(spark, sf_dir)
    return _shown(oc.write_task_results(views.catalog(spark, sf_dir), results, _now(), "idx_9"))


def _embedding_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An embedding result for each customer with a name in the catalogue and beyond; debtors fail."""
    n = F.col("c_custkey")
    good = F.col("c_acctbal") >= 0
    return views.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("v"), (n + 100).cast("string")).alias("video_id"),
        F.when(good, F.concat(F.lit("embeddings/v"), (n + 100).cast("string"), F.lit(".npy"))).alias("embedding_s3"),
        F.when(~good, F.concat(F.lit("no credit: "), "c_mktsegment")).alias("error"),
    )


_EMBEDDED = """results AS (SELECT 'v' || (c_custkey + 100) AS video_id,
    CASE WHEN c_acctbal >= 0 THEN 'embeddings/v' || (c_custkey + 100) || '.npy' END AS embedding_s3,
    CASE WHEN c_acctbal < 0 THEN 'no credit: ' || c_mktsegment END AS error FROM customer)"""


@query(
    "K6",
    sql=with_views(
        f"""SELECT coalesce(c.video_id, r.video_id) AS video_id, index_id, status,
        CASE WHEN r.video_id IS NULL THEN embedding_status WHEN embedding_s3 IS NULL THEN 'embedding_failed'
            ELSE 'embedded' END AS embedding_status, strftime(created_at, {_T}) AS created_at, source, embedding_s3,
        error AS embed_error, CASE WHEN r.video_id IS NOT NULL THEN '{NOW}' END AS embedded_at
        FROM catalog c FULL JOIN results r ON c.video_id = r.video_id""",
        "catalog",
        ctes=_EMBEDDED,
    ),
)
def apply_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = _embedding_results(spark, sf_dir)
    return _shown(oc.apply_embedding_results(views.catalog(spark, sf_dir), results, _now()))


@query(
    "A2",
    sql=with_views(
        """SELECT count(embedding_s3) AS success, count(*) FILTER (embedding_s3 IS NULL) AS failed, count(*) AS total
        FROM results""",
        "catalog",
        ctes=_EMBEDDED,
    ),
)
def embedding_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oc.embedding_summary(_embedding_results(spark, sf_dir))


@query(
    "P18",
    sql=with_views(
        f"""SELECT video_id, '' AS s3_key, '' AS s3_uri, index_id, coalesce(status, '') AS status, embedding_status,
        0::BIGINT AS size_bytes, 0::DOUBLE AS size_mb, strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS created_at,
        NULL::VARCHAR AS indexed_at, NULL::VARCHAR AS embedded_at, NULL::VARCHAR AS embedding_s3,
        NULL::DOUBLE AS duration_sec, source AS tag FROM catalog""",
        "catalog",
    ),
)
def served_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The read API's columns; the tags map is shown by its one entry."""
    tagged = views.catalog(spark, sf_dir).withColumn("tags", F.create_map(F.lit("segment"), F.col("source")))
    served = oc.served_projection(tagged)
    return served.withColumn("tag", served["tags"]["segment"]).drop("tags")


@query(
    "K12", "C5",
    sql=with_views(
        f"""SELECT {_CATALOG}, NULL AS embedding_s3 FROM catalog WHERE video_id NOT IN
            (SELECT video_id FROM raw_metadata WHERE coalesce(video_id, '') <> '')
        UNION ALL SELECT video_id, index_id, status, NULL, NULL, source, embedding_s3 FROM raw_metadata
        WHERE coalesce(video_id, '') <> ''""",
        "catalog",
        "raw_metadata",
    ),
)
def persist_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle records replace catalogue rows; those without an id are left out."""
    records = views.raw_metadata(spark, sf_dir).select(
        "video_id", "index_id", "status", "source", F.col("embedding_s3").alias("embedding_s3_key"), F.col("s3_key").alias("seq")
    )
    return _shown(oc.persist_lifecycle(views.catalog(spark, sf_dir), records, "seq"))


@query("S8", "K2", "T4", sql=with_views(_REPLACED, "catalog", "updates", ctes=_LATEST))
def catalog_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert through the stored table: a snapshot, a batch of changes, and the same batch once more."""
    table = ChangeLog(spark, run_dir(spark, "catalog"))
    table.create(views.catalog(spark, sf_dir).withColumn("updated_at", F.lit(None).cast("timestamp")))
    changes = views.updates(spark, sf_dir)
    for _ in range(2):
        table.apply(changes, put("seq"), "check", 0)
    return _shown(table.read())


@query(
    "K3", "A1", "S8",
    sql=with_views(
        """SELECT count(*) FILTER (outcome = 'written') AS success, count(*) FILTER (outcome = 'skipped') AS skipped,
        count(*) FILTER (outcome = 'failed') AS failed, count(*) AS total FROM outcomes""",
        "catalog",
        "updates",
        ctes=_OUTCOMES,
    ),
)
def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A guarded batch into the stored table, and its counts."""
    table = ChangeLog(spark, run_dir(spark, "catalog"))
    table.create(views.catalog(spark, sf_dir).withColumn("updated_at", F.lit(None).cast("timestamp")))
    counts = table.upsert(views.updates(spark, sf_dir), "seq", guard=True)
    return spark.createDataFrame([counts], "success long, skipped long, failed long, total long")


@query(
    "K11", "S8",
    sql=with_views(
        f"""SELECT {_CATALOG} FROM catalog WHERE (index_id, video_id) NOT IN
        (SELECT 'idx_' || (o_custkey % 4), 'v' || o_custkey FROM orders WHERE o_orderstatus = 'P')""",
        "catalog",
    ),
)
def catalog_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delete through the stored table."""
    table = ChangeLog(spark, run_dir(spark, "catalog"))
    table.create(views.catalog(spark, sf_dir))
    table.delete(_deleted(spark, sf_dir))
    table.compact()
    return _shown(table.read())
