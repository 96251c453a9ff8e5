"""The stored catalogue: a snapshot folded with its log, against puts and sets one by one."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mediacat.operators import catalog as oc
from mediacat.sources.change_log import ChangeLog, put, set_columns

ROW = "video_id string, status string, note string"
UPDATES = ROW + ", seq long"


def rows_of(df):
    return {r.video_id: tuple(r[c] for c in df.columns if c != "video_id") for r in df.collect()}


@pytest.fixture
def stored(spark, folder):
    table = ChangeLog(spark, folder)
    table.create(spark.createDataFrame([(f"v{i:03}", "embedded" if i % 3 == 0 else "ready", f"n{i}") for i in range(60)], ROW))
    return table


def test_batches_equal_single_steps(spark, stored):
    """Puts, sets, deletes and compactions in random order."""
    rng = random.Random(5)
    want = rows_of(stored.read())
    for step in range(9):
        updates = [(f"v{rng.randrange(75):03}", rng.choice(["ready", "failed", None]), rng.choice(["x", None]), n) for n in range(12)]
        frame = spark.createDataFrame(updates, UPDATES)
        kind = step % 4
        if kind == 0:
            stored.apply(frame, put("seq"))
            want |= {k: (s, n) for k, s, n, _ in updates}
        elif kind == 1:
            stored.apply(frame, set_columns("seq", {"note": F.col("status").isNotNull()}))
            for k, s, n, _ in updates:
                old = want.setdefault(k, (None, None))  # a key that a set names becomes a row, whatever it sets
                if s is not None:
                    want[k] = (old[0], n)
        elif kind == 2:
            stored.apply(frame.withColumn("gone", F.col("note").isNull()), put("seq", gone="gone"))
            for k, s, n, _ in updates:
                want[k] = None if n is None else (s, n)
            want = {k: v for k, v in want.items() if v is not None}
        else:
            stored.compact()
        assert rows_of(stored.read()) == want
    assert stored.read().count() == len(want)


def test_a_set_that_sets_nothing_still_makes_a_row(spark, stored):
    """As in `upsert_merge`: the key is there afterwards, its columns are null."""
    change = spark.createDataFrame([("new", None, "n", 1)], UPDATES)
    stored.apply(change, set_columns("seq", {"note": F.col("status").isNotNull()}))
    whole = oc.upsert_merge(spark.createDataFrame([], ROW), change, "seq", {"note": F.col("status").isNotNull()})
    assert rows_of(stored.get("new")) == rows_of(whole) == {"new": (None, None)}


def test_a_batch_that_comes_again_counts_once_and_where_it_came_first(spark, stored):
    one = spark.createDataFrame([("v001", "first", None, 1)], UPDATES)
    two = spark.createDataFrame([("v001", "second", None, 1)], UPDATES)
    at = stored.apply(one, put("seq"), "w", 0)
    assert stored.apply(two, put("seq"), "other", 0) == at + 1
    assert stored.apply(one, put("seq"), "w", 0) == at  # a late replay does not pass the newer batch
    assert rows_of(stored.get("v001")) == {"v001": ("second", None)}
    stored.compact()
    assert stored.apply(one, put("seq"), "w", 0) == at and rows_of(stored.get("v001")) == {"v001": ("second", None)}
    assert stored.apply(one, put("seq"), "w", 1) == at + 2


def test_a_batch_that_died_is_overwritten(spark, stored):
    at = stored.apply(spark.createDataFrame([("v001", "half", None, 1), ("v002", "half", None, 1)], UPDATES), put("seq"), "w", 7)
    stored.apply(spark.createDataFrame([("v001", "whole", None, 1)], UPDATES), put("seq"), "w", 7)
    assert rows_of(stored.get("v001")) == {"v001": ("whole", None)} and rows_of(stored.get("v002")) == {"v002": ("ready", "n2")}
    assert list(stored._batches().values()) == [at]


def test_a_snapshot_without_head_is_not_read(spark, stored, folder):
    spark.createDataFrame([("zzz", "lost", None)], ROW).write.parquet(f"{folder}/snapshot/_upto=9")
    assert "zzz" not in rows_of(stored.read())


def test_guarded_upsert_counts_what_it_writes(spark, stored):
    """The updates differ each time they are evaluated; the counts are those of the rows that were written."""
    fresh = spark.range(200).select(
        F.concat(F.lit("x"), (F.rand() * 1000).cast("long")).alias("video_id"), F.lit("ready").alias("status"), F.lit("n").alias("note"), F.col("id").alias("seq")
    )
    named = spark.createDataFrame([("v000", "ready", None, 1), ("v001", "failed", None, 2), (None, "x", None, 3), ("", "x", None, 4)], UPDATES)
    counts = stored.upsert(fresh.unionByName(named), "seq", guard=True)
    assert counts == {"success": 201, "skipped": 1, "failed": 2, "total": 204}
    assert rows_of(stored.get("v000"))["v000"][0] == "embedded" and rows_of(stored.get("v001"))["v001"][0] == "failed"
    whole = oc.upsert_replace(spark.createDataFrame([(k, *v) for k, v in rows_of(stored.read()).items()], ROW), named, "seq", guard=True)
    assert rows_of(whole) == rows_of(stored.read())


def test_columns_are_gained_and_types_kept(spark, stored):
    stored.apply(spark.createDataFrame([("v001", "s", 7, 1)], "video_id string, status string, extra int, seq int"), put("seq"))
    stored.apply(spark.createDataFrame([("v002", 8, 1)], "video_id string, extra long, seq int"), set_columns("seq", {"extra": None}))
    for _ in range(2):
        rows = {r.video_id: (r.status, r.note, r.extra) for r in stored.read().collect()}
        assert rows["v001"] == ("s", None, 7) and rows["v002"] == ("ready", "n2", 8) and rows["v003"] == ("embedded", "n3", None) and len(rows) == 60
        assert stored.read().schema["extra"].dataType.simpleString() == "int"
        stored.compact()


def test_deletes_name_index_and_video(spark, folder):
    table = ChangeLog(spark, folder)
    table.create(spark.createDataFrame([("a", "i"), ("b", "i"), ("c", None)], "video_id string, index_id string"))
    table.delete(spark.createDataFrame([("a", "i"), ("b", "j"), ("a", "i")], "video_id string, index_id string"))
    assert rows_of(table.read()) == {"b": ("i",), "c": (None,)}


def test_empty_tables_and_missing_ones(spark, folder):
    table = ChangeLog(spark, folder)
    with pytest.raises(ValueError):
        table.read()
    with pytest.raises(ValueError):
        table.append(spark.createDataFrame([("a", "put")], "video_id string, _op string"))
    table.create(spark.createDataFrame([], ROW))
    assert table.read().count() == 0
    table.apply(spark.createDataFrame([("a", "s", None, 1)], UPDATES), put("seq"))
    table.create(spark.createDataFrame([("b", "s", None)], ROW))
    assert rows_of(table.read()) == {"b": ("s", None)}


def test_a_lookup_needs_one_row_group(spark, folder):
    """In a table as it is handed in every row group may hold a key; in the snapshot one does."""
    rows = spark.range(40_000).select(F.concat(F.lit("v"), F.pmod(F.col("id") * 7919, F.lit(40_000)).cast("string")).alias("video_id"), F.lit("s").alias("status"))
    rows.repartition(8).write.option("parquet.block.size", 16_384).parquet(f"{folder}/plain")
    table = ChangeLog(spark, f"{folder}/table")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.create(spark.read.parquet(f"{folder}/plain"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def groups(path):
        hold = total = 0
        for file in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(0).statistics
                total += 1
                hold += stats.min <= "v12345" <= stats.max
        return hold, total

    before, after = groups(f"{folder}/plain"), groups(f"{folder}/table/snapshot/_upto=0")
    assert before[0] == before[1] >= 8 and after[0] == 1 and after[1] >= 8
    assert table.get("v12345").count() == 1 and table.get("absent").count() == 0
    plan = table.get("v12345")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(video_id,v12345)" in plan
