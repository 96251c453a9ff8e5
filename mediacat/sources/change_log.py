"""The keyed catalogue as plain Parquet: a snapshot and the changes since.

    snapshot/_upto=N       the whole table with all changes numbered up to N, sorted by key
    log/_at=N/_batch=B     one batch of changes: at most one row per key
    head/_upto=N           one row, written after snapshot N: its schema; the newest one counts

A change is a row of the table's columns with `_op`: `put` writes the whole row, `set` the columns named in `_set`, `gone` takes the
row away. The current table is the snapshot joined with the log folded to one row per key: the last batch that wrote a
column decides it. A batch has its own folder, written by Spark's file sink; one that is delivered again overwrites
its folder and keeps its number. Any Parquet reader can read a snapshot; `compact` makes the next one. One writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.operators.catalog import KEY, _existing_keys, folded, latest_per_key, split_blank_keys, upsert_outcomes

OP, SET, AT, BATCH = "_op", "_set", "_at", "_batch"

# Turns updates into rows of the log.
Change = Callable[[DataFrame], DataFrame]


def put(seq: str, gone: str | None = None) -> Change:
    """Whole rows, the last one of each key in `seq` order. A last write whose column `gone` is true takes its row away."""

    def change(updates: DataFrame) -> DataFrame:
        last = latest_per_key(split_blank_keys(updates)[0], [F.desc(seq)])
        op = F.lit("put") if gone is None else F.when(F.col(gone), "gone").otherwise("put")
        return last.withColumn(OP, op).drop(seq, *([] if gone is None else [gone]))

    return change


def set_columns(seq: str, columns: Mapping[str, Column | None]) -> Change:
    """The named columns of a key, each where its condition holds (None: always), repeated updates in `seq` order."""

    def change(updates: DataFrame) -> DataFrame:
        changes = folded(updates, seq, columns)
        named = F.filter(F.array(*(F.when(F.col(f"_set_{n}").isNotNull(), F.lit(n)) for n in columns)), lambda n: n.isNotNull())
        values = (F.col(f"_set_{n}")["v"].alias(n) for n in columns)
        return changes.select(KEY, F.lit("set").alias(OP), named.alias(SET), *values)

    return change


def fold(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """The snapshot with the changes of the log. Changes are reduced by partial aggregates before anything is joined."""
    names = [c for c in snapshot.columns if c != KEY]
    names += [c for c in log.columns if c not in (KEY, OP, SET, AT, BATCH, *names)]
    types = {f.name: f.dataType for f in [*log.schema.fields, *snapshot.schema.fields]}

    def last(name: str) -> Column:
        writes = (F.col(OP) != "set") | F.coalesce(F.array_contains(SET, name), F.lit(False))
        return F.max_by(F.struct(F.col(name).alias("v")), F.when(writes, F.col(AT)))

    written = [n for n in names if n in log.columns]
    whole = F.max(F.when(F.col(OP) != "set", F.col(AT)))  # a put without a column of the table makes it null
    changes = log.groupBy(KEY).agg(
        F.max_by(OP, AT).alias(OP), whole.isNotNull().alias("_whole"), *(last(n).alias(f"_new_{n}") for n in written)
    )

    def merged(rows: DataFrame) -> DataFrame:
        out = []
        for name in names:
            old = F.col(name) if name in rows.columns else F.lit(None).cast(types[name])
            if name in written:
                new = F.col(f"_new_{name}")
                old = F.when(new.isNotNull(), new["v"].cast(types[name])).otherwise(old)
            else:
                old = F.when(~F.coalesce("_whole", F.lit(False)), old)
            out.append(old.alias(name))
        return rows.filter(F.coalesce(F.col(OP) != "gone", F.lit(True))).select(KEY, *out)

    fresh = changes.join(_existing_keys(snapshot, changes), KEY, "left_anti")
    together = merged(snapshot.join(changes, KEY, "left")).unionByName(merged(fresh))
    return together.select(*snapshot.columns, *(n for n in names if n not in snapshot.columns))


class ChangeLog:
    """A table keyed by `video_id` under `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def _folders(self, part: str, pattern: str) -> list[tuple]:
        """What `pattern` finds in the folder names below `part`, by listing alone."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.path}/{part}")
            rows = files.select(F.regexp_extract_all("path", F.lit(pattern), F.lit(0)).alias("m")).filter(F.size("m") > 0)
            return [re.search(pattern, r["m"][-1]).groups() for r in rows.distinct().collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _newest(self) -> int | None:
        """Number of the newest snapshot, None before `create`."""
        return max((int(n) for n, in self._folders("head", r"/_upto=(\d+)/")), default=None)

    def _batches(self) -> dict[str, int]:
        """Number of every batch in the log; as many as were written since the log's old folders were taken away."""
        return {name: int(at) for at, name in self._folders("log", rf"/{AT}=(\d+)/{BATCH}=([^/]+)/")}

    def create(self, rows: DataFrame) -> None:
        """Make `rows` the table; whatever it held before is gone."""
        self._snapshot(rows, max(self._batches().values(), default=-1 if self._newest() is None else self._newest()) + 1)

    def _snapshot(self, rows: DataFrame, upto: int) -> None:
        """Rows lie in ranges of the key, sorted, with bloom filters: a lookup reads few row groups."""
        stored = rows.repartitionByRange(F.col(KEY)).sortWithinPartitions(KEY)
        writer = stored.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{KEY}", "true")
        writer.parquet(f"{self.path}/snapshot/_upto={upto}")
        head = self.spark.createDataFrame([(json.dumps(rows.schema.jsonValue()),)], "schema string")
        head.coalesce(1).write.mode("overwrite").json(f"{self.path}/head/_upto={upto}")

    def read(self, keys: Column | None = None) -> DataFrame:
        """The current rows, or those whose key meets a condition, which then reaches both scans."""
        upto = self._newest()
        if upto is None:
            raise ValueError("create the table first")
        schema = self.spark.read.schema("schema string").json(f"{self.path}/head/_upto={upto}").first()["schema"]
        snapshot = self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(f"{self.path}/snapshot/_upto={upto}")
        later = [f"{self.path}/log/{AT}={at}/{BATCH}={name}" for name, at in self._batches().items() if at > upto]
        if keys is not None:
            snapshot = snapshot.filter(keys)
        if not later:
            return snapshot
        log = self.spark.read.option("basePath", f"{self.path}/log").option("mergeSchema", True).parquet(*later)
        log = log if SET in log.columns else log.withColumn(SET, F.lit(None).cast("array<string>"))
        return fold(snapshot, log if keys is None else log.filter(keys))

    def get(self, video_id: str) -> DataFrame:
        """The row of one video."""
        return self.read(F.col(KEY) == video_id)

    def append(self, changes: DataFrame, writer: str | None = None, batch_id: int = 0) -> int:
        """Write one batch of changes and return its number; `changes` has at most one row per key, as `put` and `set_columns` give.

        A batch of a `writer` that is there already is written again in its place, so it counts once and where it came first; one
        that a snapshot holds already is left as it is.
        """
        upto = self._newest()
        if upto is None:
            raise ValueError("create the table first")
        name = uuid.uuid4().hex if writer is None else re.sub(r"[^\w.-]", "_", f"{writer}-{batch_id}")
        known = self._batches()
        at = known.get(name, max([upto, *known.values()]) + 1)
        if at <= upto:
            return at
        types = {f.name: f.dataType for f in self.read().schema.fields}
        shaped = changes.select(*(F.col(c).cast(types[c]) if c in types else F.col(c) for c in changes.columns))
        shaped.write.mode("overwrite").parquet(f"{self.path}/log/{AT}={at}/{BATCH}={name}")
        return at

    def apply(self, updates: DataFrame, change: Change, writer: str | None = None, batch_id: int = 0) -> int:
        """Append what `change` makes of the updates."""
        return self.append(change(updates), writer, batch_id)

    def delete(self, keys: DataFrame) -> int:
        """Take away the videos named by (index_id, video_id)."""
        named = keys.select("index_id", KEY).distinct()
        found = self.read().select("index_id", KEY).join(named, ["index_id", KEY], "left_semi")
        return self.append(found.select(KEY, F.lit("gone").alias(OP)))

    def upsert(self, updates: DataFrame, seq: str, guard: bool = False, writer: str | None = None, batch_id: int = 0) -> dict[str, int]:
        """Put whole rows, with `guard` only where the row is not `embedded` yet; returns the counts success, skipped, failed and total.

        The counts are taken of the rows on their way into the log, so they are what was written.
        """
        seen = Observation()
        outcome = F.col("outcome")
        counted = upsert_outcomes(self.read().select(KEY, "status"), updates, seq, guard).observe(
            seen,
            F.count_if(outcome == "written").alias("success"), F.count_if(outcome == "skipped").alias("skipped"),
            F.count_if(outcome == "failed").alias("failed"), F.count(F.lit(1)).alias("total"),
        )
        self.append(put(seq)(counted.filter(outcome == "written").drop("outcome")), writer, batch_id)
        return dict(seen.get)

    def compact(self) -> int:
        """Fold the log into the next snapshot and return its number. Older folders are no longer read and may be taken away."""
        upto = max([self._newest() or 0, *self._batches().values()])
        self._snapshot(self.read(), upto)
        return upto
