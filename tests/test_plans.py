"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.operators import paging, search, tasks
from mediacat.plans import batch_metadata, views

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_transform_is_one_stage(spark):
    text = plan(batch_metadata.transform(views.raw_metadata(spark, SF_DIR)))
    assert "Exchange" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    views.catalog(spark, SF_DIR).write.parquet(folder)
    stored = spark.read.parquet(folder)
    text = plan(paging.get_video(stored, "v1").select("status"))
    assert "EqualTo(video_id,v1)" in text and "ReadSchema: struct<video_id:string,status:string>" in text
    text = plan(oc.pending_embedding(stored, 200))
    assert "EqualTo(status,ready)" in text and "EqualTo(embedding_status,pending)" in text
    assert "TakeOrderedAndProject" in text


def test_search_filters_before_scoring(spark, folder):
    views.vectors(spark, SF_DIR).write.parquet(folder)
    hits = search.search(spark.read.parquet(folder), views.first_query(spark, SF_DIR))
    text = plan(hits)
    scan = text[text.index("MapInArrow") :]
    assert "In(modality, [conversation,visual])" in scan and "Exchange" not in scan
    assert "WindowGroupLimit" in text


def test_latest_per_key_is_cut_on_both_sides_of_the_shuffle(spark):
    text = plan(oc.latest_per_key(views.updates(spark, SF_DIR), [F.desc("seq")]))
    assert text.count("WindowGroupLimit") == 2 and ", Partial" in text


def test_small_changes_do_not_shuffle_the_table(spark, folder):
    views.catalog(spark, "/root/testdata/sf0.01").write.parquet(folder)
    target = spark.read.parquet(folder)
    changes = spark.createDataFrame([("v1", "ready", 1)], "video_id string, status string, seq int")
    for result in (
        oc.upsert_replace(target, changes, "seq"),
        oc.upsert_replace(target, changes, "seq", guard=True),
        oc.upsert_merge(target, changes, "seq", {"status": None}),
    ):
        result.collect()
        text = plan(result)
        final = text[text.index("Final Plan") : text.index("Initial Plan")] if "Initial Plan" in text else text
        assert "SortMergeJoin" not in final
        assert "BroadcastHashJoin" in final


def test_deadline_joins_only_the_summary(spark):
    text = plan(tasks.task_deadline(views.task_events(spark, SF_DIR), key="user_id"))
    assert "partial_min" in text


SPLIT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def splitting(spark):
    before = {key: spark.conf.get(key, None) for key in SPLIT}
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, folder, key):
    """200,000 rows, half of which have one key, in several files."""
    n = F.col("id")
    rows = spark.range(200_000).select(
        F.when(n % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (n % 5000).cast("string"))).alias(key),
        n.alias("seq"), n.alias("event_id"), n.alias("pos"), F.sha2(n.cast("string"), 256).alias("note"),
        F.when(n % 7 == 0, "ready").otherwise("submitted").alias("status"), F.timestamp_seconds(n).alias("ts"),
    )
    rows.repartition(8).write.parquet(f"{folder}/hot")
    return spark.read.parquet(f"{folder}/hot")


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    rows = df.agg(F.count(F.lit(1)), *[F.max(c) for c in df.columns])
    rows.collect()
    return plan(rows)


def test_hot_tasks_are_split(splitting, folder):
    events = hot(splitting, folder, "task_id")
    submitted = events.filter("status = 'submitted'").select("task_id", "note")
    assert "skew=true" in final_plan(tasks.task_status(submitted, events))


def test_hot_updates_are_split(splitting, folder):
    updates = hot(splitting, folder, "video_id")
    target = updates.select("video_id").distinct().withColumn("status", F.lit("embedded"))
    assert "skew=true" in final_plan(oc.upsert_outcomes(target, updates, "seq", guard=True))


def test_hot_inputs_are_split(splitting, folder):
    results = hot(splitting, folder, "s3_uri")
    inputs = results.select("pos", "s3_uri", F.col("note").alias("asked"))
    assert "skew=true" in final_plan(tasks.batch_results(inputs, results.select("s3_uri", "status", "seq"), "seq"))


def test_hot_videos_are_split_before_scoring(splitting, folder):
    from mediacat.operators.joins import spread_join

    rows = hot(splitting, folder, "video_id")
    allowed = rows.select("video_id").distinct()
    assert "skew=true" in final_plan(spread_join(rows, allowed, "video_id", "left_semi"))
