"""The partitioned listing against os.walk, and repeated task states."""

import os
import random
from datetime import datetime, timedelta, timezone

import pytest

from mediacat.sources.listing_source import LAST, ListingReader, ListingStream, ObjectListing, Store
from mediacat.sources.task_events import final_states, first_deliveries

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def touch(root, *keys):
    for key in keys:
        os.makedirs(os.path.dirname(f"{root}/{key}"), exist_ok=True)
        with open(f"{root}/{key}", "w") as f:
            f.write(key)


def walked(root):
    found = [os.path.relpath(os.path.join(d, f), root) for d, _, files in os.walk(root) for f in files]
    return sorted(k for k in found if not any(p[0] in "._" for p in k.split("/")))


@pytest.fixture
def tree(folder):
    rng = random.Random(6)
    keys = {"/".join(rng.choices(["a", "a.x", "b", "ab", "c-d"], k=rng.randint(0, 3)) + [f"f{rng.randrange(40)}.mp4"]) for _ in range(150)}
    touch(folder, *keys, "a/_SUCCESS", ".hidden/x.mp4", "a/.part.crc")
    os.makedirs(f"{folder}/empty/below", exist_ok=True)
    return folder


def test_listing_equals_walk(spark, tree):
    spark.dataSource.register(ObjectListing)
    listed = spark.read.format("object_listing").options(root=tree, bucket="raw").load()
    rows = listed.collect()
    assert sorted(r.s3_key for r in rows) == walked(tree) and {r.bucket for r in rows} == {"raw"}
    assert all(r.size_bytes == len(r.s3_key) and r.last_modified is not None for r in rows)
    options = {"root": tree, "bucket": "raw"}
    assert {p.name for p in ListingReader(options).partitions()} == {"", *(f"{d}/" for d in os.listdir(tree) if os.path.isdir(f"{tree}/{d}") and d[0] not in "._")}
    some = spark.read.format("object_listing").options(root=tree, prefixes='["a", "ab/"]').load()
    assert sorted(r.s3_key for r in some.collect()) == [k for k in walked(tree) if k.startswith(("a/", "ab/"))]


def test_ranges_of_keys_and_last_keys(tree):
    store, keys = Store({"root": tree}), walked(tree)
    for prefix in store.prefixes()[1:]:
        mine = [k for k in keys if k.startswith(prefix)]
        assert [k for k, _ in store.keys(prefix, "", LAST)] == mine and store.last_key(prefix) == max(mine, default="")
        for start in mine[:: max(1, len(mine) // 5)]:
            for end in mine[:: max(1, len(mine) // 4)]:
                assert [k for k, _ in store.keys(prefix, start, end)] == [k for k in mine if start < k <= end]
    assert [k for k, _ in store.keys("", "", LAST)] == [k for k in keys if "/" not in k] and Store({"root": f"{tree}/none"}).prefixes() == [""]


def test_a_stream_goes_on_behind_the_last_keys(spark, folder):
    spark.dataSource.register(ObjectListing)

    def run():
        arriving = spark.readStream.format("object_listing").options(root=f"{folder}/in", bucket="b").load()
        writer = arriving.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
        writer.trigger(availableNow=True).start().awaitTermination()
        return sorted(r.s3_key for r in spark.read.parquet(f"{folder}/out").collect())

    touch(f"{folder}/in", "p/1/a", "p/2/b", "q/1/a", "top1")
    assert run() == ["p/1/a", "p/2/b", "q/1/a", "top1"]
    touch(f"{folder}/in", "p/3/a", "r/1/a", "top2")
    assert run() == run() == ["p/1/a", "p/2/b", "p/3/a", "q/1/a", "r/1/a", "top1", "top2"]
    stream = ListingStream({"root": f"{folder}/in"})
    end = stream.latestOffset()
    assert end == {"": "top2", "p/": "p/3/a", "q/": "q/1/a", "r/": "r/1/a"}
    assert [p.name for p in stream.partitions({**end, "q/": ""}, end)] == ["q/"]


def test_repeated_deliveries_give_the_same_outcome(spark, folder):
    """Each event comes one to three times, over five deliveries; the state does not grow with the events."""
    rng = random.Random(9)
    schema = "task_id string, video_id string, status string, ts timestamp"
    events = [(f"t{i % 40}", f"v{i}", rng.choice(["submitted", "ready", "failed"]), START + timedelta(minutes=i)) for i in range(600)]
    state = 0
    for part in range(5):
        rows = [e for e in events[120 * part : 120 * part + 120] for _ in range(rng.randint(1, 3))]
        rows += events[max(0, 120 * part - 20) : 120 * part]  # what came last before comes again
        rng.shuffle(rows)
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        stream = first_deliveries(spark.readStream.schema(schema).parquet(f"{folder}/in"))
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/c")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        state = max(state, *(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]))
    log = spark.read.schema(schema).parquet(f"{folder}/out")
    once = spark.createDataFrame(events, schema)
    assert sorted(log.collect()) == sorted(once.collect()) and state < 400
    assert sorted(final_states(log).collect()) == sorted(final_states(once).collect())
    twice = final_states(once.unionByName(once)).drop("events").collect()
    assert sorted(twice) == sorted(final_states(once).drop("events").collect())
    assert final_states(once.limit(0)).collect() == []
