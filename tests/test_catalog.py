"""Upserts, merges, deletes, lookups and the stored table."""

import random

import pytest
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.operators import paging


def now():
    return F.lit("2024-06-01").cast("timestamp")


def table(spark, rows, ddl="video_id string, status string, note string"):
    return spark.createDataFrame(rows, ddl)


def found(df, *columns):
    return sorted([tuple(r[c] for c in columns or df.columns) for r in df.collect()], key=repr)


def apply_one_by_one(target, updates, guard):
    """The meaning of an upsert: updates in order, one put each."""
    state = {k: (s, n) for k, s, n in target}
    for key, status, note, _ in sorted(updates, key=lambda u: u[3]):
        if not key or (guard and key in state and state[key][0] == "embedded"):
            continue
        state[key] = (status, note)
    return sorted([(k, *v) for k, v in state.items()], key=repr)


@pytest.mark.parametrize("guard", [False, True])
def test_upsert_equals_single_puts(spark, guard):
    rng = random.Random(3)
    words = ["embedded", "ready", None, "failed"]
    target = [(f"v{i}", rng.choice(words), f"old{i}") for i in range(40)]
    keys = [f"v{rng.randrange(60)}" for _ in range(150)] + ["v1"] * 80 + ["", None]
    updates = [(k, rng.choice(words), f"n{i}", i) for i, k in enumerate(keys)]
    rng.shuffle(updates)
    df = table(spark, updates, "video_id string, status string, note string, seq long")
    result = oc.upsert_replace(table(spark, target), df, "seq", guard)
    assert found(result) == apply_one_by_one(target, updates, guard)
    assert found(oc.upsert_replace(result, df, "seq", guard)) == found(result)
    outcomes = oc.upsert_outcomes(table(spark, target), df, "seq", guard)
    counts = oc.upsert_summary(outcomes).first()
    assert counts.failed == 2 and counts.total == len(updates)
    assert counts.success + counts.skipped + counts.failed == counts.total
    assert (counts.skipped > 0) == guard


def test_guard_lets_null_status_through(spark):
    target = table(spark, [("a", None, "x"), ("b", "embedded", "x")])
    updates = table(spark, [("a", "ready", "y", 1), ("b", "ready", "y", 2)], "video_id string, status string, note string, seq int")
    assert found(oc.upsert_replace(target, updates, "seq", guard=True)) == [("a", "ready", "y"), ("b", "embedded", "x")]


def test_replace_discards_columns_and_adds_new_ones(spark):
    target = table(spark, [("a", "x", "kept"), ("b", "x", "kept")])
    updates = table(spark, [("a", "y", 1.5, 1)], "video_id string, status string, size double, seq int")
    result = oc.upsert_replace(target, updates, "seq")
    assert result.columns == ["video_id", "status", "note", "size"]
    assert found(result) == [("a", "y", None, 1.5), ("b", "x", "kept", None)]


def test_merge_sets_null_keeps_others_and_folds_repeats(spark):
    target = table(spark, [("a", "old", "n1"), ("b", "old", "n2")])
    rows = [("a", None, "x", False, 1), ("a", "s", "y", True, 0), ("c", "new", "z", True, 5), ("", "q", "q", True, 1)]
    updates = table(spark, rows, "video_id string, status string, note string, set_note boolean, seq int")
    result = oc.upsert_merge(target, updates, "seq", {"status": None, "note": F.col("set_note")})
    assert found(result) == sorted([("a", None, "y"), ("b", "old", "n2"), ("c", "new", "z")], key=repr)


def test_update_status_makes_missing_rows(spark):
    updates = table(spark, [("z", "failed", "why", 1)], "video_id string, status string, note string, seq int")
    result = oc.update_status(table(spark, [("a", "ready", "n")]), updates, "seq", now(), ["note"])
    assert found(result, "video_id", "status", "note") == [("a", "ready", "n"), ("z", "failed", "why")]
    assert result.filter("video_id = 'z'").first().updated_at is not None


def test_embedding_results_touch_only_their_columns(spark):
    ddl = "video_id string, embedding_status string, embedding_s3 string, embed_error string, embedded_at timestamp"
    target = table(spark, [("a", "pending", "p0", None, None), ("b", "pending", "p1", None, None), ("c", "x", None, "e0", None)], ddl)
    results = table(spark, [("a", "p", None), ("b", "", "boom"), ("d", None, None)], "video_id string, embedding_s3 string, error string")
    got = found(oc.apply_embedding_results(target, results, now()), "video_id", "embedding_status", "embedding_s3", "embed_error")
    assert got == [
        ("a", "embedded", "p", None), ("b", "embedding_failed", "p1", "boom"), ("c", "x", None, "e0"), ("d", "embedding_failed", None, None),
    ]
    no_error = oc.apply_embedding_results(target, results.drop("error"), now())
    assert no_error.filter("video_id = 'b'").first().embed_error == "unknown"
    assert tuple(oc.embedding_summary(results).first()) == (1, 2, 3)


def test_task_results(spark):
    results = table(
        spark, [("k1", "t1", "ready", "v1"), ("k2", "t2", "ready", ""), ("k3", None, "upload_failed", None)],
        "s3_key string, task_id string, status string, video_id string",
    )
    rows = oc.task_result_rows(results, "idx", now())
    assert found(rows, "video_id", "embedding_status") == [("no-id-k2", "pending"), ("no-id-k3", "skipped"), ("v1", "pending")]


def test_lifecycle_rows_without_id_are_kept_aside(spark):
    records = table(spark, [("a", "s", "p"), (None, "s", "p")], "video_id string, status string, embedding_s3_key string")
    rows, rejects = oc.lifecycle_rows(records)
    assert rows.columns == ["video_id", "status", "embedding_s3"] and rows.count() == rejects.count() == 1


def test_delete(spark):
    ddl = "video_id string, index_id string"
    target = table(spark, [("a", "i"), ("a", "j"), ("b", "i"), ("c", None)], ddl)
    assert found(oc.delete_rows(target, table(spark, [("a", "i"), ("a", "i"), ("z", "i")], ddl))) == [("a", "j"), ("b", "i"), ("c", None)]
    assert found(oc.delete_index(target, "i")) == [("a", "j"), ("c", None)]


def test_store_stage(spark):
    df = table(spark, [("a", [1.0]), ("b", []), ("c", None)], "video_id string, embedding array<float>")
    rows = found(oc.store_stage(df, now()), "video_id", "status", "embedding_dim", "embedding_s3")
    assert rows == [("a", "embedded", 1, "embeddings/a.npy"), ("b", "embedding", 0, None), ("c", "embedding", 0, None)]


def test_served_columns(spark):
    df = spark.createDataFrame([("a", None, {}, 0.0)], "video_id string, size_bytes long, tags map<string,string>, duration_sec double")
    served = oc.served_projection(df)
    row = served.first()
    assert len(served.columns) == 14
    assert (row.size_bytes, row.s3_key, row.indexed_at, row.duration_sec, row.tags) == (0, "", None, None, None)


@pytest.mark.parametrize(
    "value, limit",
    [(None, 20), ("", 20), ("7", 7), (7, 7), ("+7", 7), ("0", 20), ("-1", 20), ("100", 100), ("101", 20), ("x", 20), ("1.0", 20), (" 7", 20)],
)
def test_limits_fall_back_to_the_default(value, limit):
    assert paging.clamp_limit(value, 20, 100) == limit


def test_pages_follow_each_other(spark):
    df = spark.range(95).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("video_id"))
    seen, last = [], None
    while True:
        page = paging.list_videos(df, 30, last)
        seen += [r.video_id for r in page.collect()]
        last = paging.page_info(page, 30).first().last_evaluated_key
        if last is None:
            break
    assert seen == sorted(f"v{i}" for i in range(95))


def test_deep_pages_equal_shallow_ones(spark, monkeypatch):
    df = spark.range(500).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("video_id"))
    shallow = [found(paging.numbered_page(df, ["video_id"], p, 60)) for p in range(1, 10)]
    monkeypatch.setattr(paging, "SHALLOW_ROWS", 0)
    assert [found(paging.numbered_page(df, ["video_id"], p, 60)) for p in range(1, 10)] == shallow


UPDATES = "video_id string, status string, note string, seq long"


def test_statuses_are_read_whole_or_page_by_page(spark):
    rows = [(f"v{i:03}", "failed", None if i % 7 == 0 else i // 3) for i in range(250)] + [("z", "ready", 1)]
    df = spark.createDataFrame(rows, "video_id string, status string, at long").select("video_id", "status", F.timestamp_seconds("at").alias("created_at"))
    assert oc.by_status(df, "failed").count() == 250
    seen, after = [], None
    while page := oc.by_status(df, "failed", 60, after).collect():
        seen += [r.video_id for r in page]
        after = (page[-1].created_at, page[-1].video_id)
    assert len(seen) == 250 and sorted(seen) == sorted(r[0] for r in rows[:250])


def test_operators_refuse_limits_that_are_none(spark):
    df = table(spark, [("a", "s", None)])
    for limit in (0, -1, "x"):
        with pytest.raises(ValueError):
            paging.list_videos(df, limit)


def test_few_changes_leave_the_table_in_place(spark, folder):
    """A wide table is scanned and written without a shuffle of its rows."""
    table(spark, [(f"v{i}", "ready", "n") for i in range(100)]).write.parquet(folder)
    current = spark.read.parquet(folder)
    updates = table(spark, [("v1", "x", None, 1)], UPDATES)
    for kept, _ in (
        oc.replace_parts(current, updates, "seq", few=True),
        oc.replace_parts(current, updates, "seq", guard=True, few=True),
        oc.merge_parts(current, updates, "seq", {"status": None}, few=True),
    ):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("FileScan parquet")
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan[:scan]
