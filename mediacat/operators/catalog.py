"""Keyed-table operators: whole-row and column-wise upserts, deletes, lookups.

Each one takes the current table and a set of changes and returns the new table. Every join puts the changes on the build
side. With `few`, for changes whose number the caller has checked, they are broadcast and the table is scanned without
being shuffled; otherwise Spark decides by the sizes it measures.

The `_parts` functions return the new table as two pieces: rows that come out of the table, still in the table's file
order when `few`, and rows that are new in it. The stored table uses this to write the first piece without moving it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacat.functions.metadata import iso_text
from mediacat.operators.joins import spread_join

KEY = "video_id"


def latest_per_key(df: DataFrame, order: Sequence[Column], key: str | Sequence[str] = KEY) -> DataFrame:
    """Last write per key. The `rn = 1` filter is applied on each side of the shuffle, so that a hot key
    sends one row per task and not all of its rows."""
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def split_blank_keys(df: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows whose key is null or empty)."""
    usable = F.col(key).isNotNull() & (F.col(key) != "")
    return df.filter(usable), df.filter(~usable)


def _build(side: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(side) if few else side


def _existing_keys(target: DataFrame, keys: DataFrame, key: str = KEY, few: bool = False) -> DataFrame:
    """Keys found in the table: at most as many as asked for, so later joins stay on the small side."""
    return target.select(key).join(_build(keys.select(key).distinct(), few), key, "left_semi")


def _effective(updates: DataFrame, seq: str, guard: bool) -> DataFrame:
    """The one update per key that is left after applying all of them in `seq` order.

    Under the guard nothing follows a row that reached `embedded`, so the first such row wins.
    """
    if not guard:
        return latest_per_key(updates, [F.desc(seq)])
    final = F.col("status").eqNullSafe("embedded")
    return latest_per_key(updates, [final.desc(), F.when(final, F.col(seq)).asc(), F.desc(seq)])


def replace_parts(
    target: DataFrame, updates: DataFrame, seq: str, guard: bool = False, few: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The pieces of `upsert_replace`: rows that stay as they are, and rows that are put."""
    updates = split_blank_keys(updates)[0]
    wins = _effective(updates, seq, guard)
    keys = updates.select(KEY).distinct()
    if guard:
        locked = _existing_keys(target.filter(F.col("status") == "embedded"), keys, few=few)
        wins = wins.join(_build(locked, few), KEY, "left_anti")
        hit = target.join(_build(keys.withColumn("_hit", F.lit(True)), few), KEY, "left")
        kept = hit.filter(F.col("_hit").isNull() | F.col("status").eqNullSafe("embedded")).drop("_hit")
    else:
        kept = target.join(_build(keys, few), KEY, "left_anti")
    columns = target.columns + [c for c in wins.columns if c not in target.columns and c != seq]
    types = {f.name: f.dataType for f in [*wins.schema.fields, *target.schema.fields]}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast(types[c]) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])

    return shaped(kept), shaped(wins)


def upsert_replace(
    target: DataFrame, updates: DataFrame, seq: str, guard: bool = False, few: bool = False
) -> DataFrame:
    """Put whole rows by key, last write wins. With `guard`, rows already `embedded` are left alone.

    `seq` orders repeated writes of a key and is not stored.
    """
    kept, wins = replace_parts(target, updates, seq, guard, few)
    return kept.unionByName(wins)


def upsert_outcomes(target: DataFrame, updates: DataFrame, seq: str, guard: bool = False) -> DataFrame:
    """Each update with `outcome` written, skipped (guard) or failed (no key)."""
    keyed = F.col(KEY).isNotNull() & (F.col(KEY) != "")
    if not guard:
        return updates.withColumn("outcome", F.when(keyed, "written").otherwise("failed"))
    locked = _existing_keys(target.filter(F.col("status") == "embedded"), updates)
    final = updates.filter(F.col("status") == "embedded").groupBy(KEY).agg(F.min(seq).alias("_final"))
    # locked keys and first final updates as one side, so that the updates are joined once
    side = final.unionByName(locked.withColumn("_locked", F.lit(True)), allowMissingColumns=True).groupBy(KEY)
    side = side.agg(F.min("_final").alias("_final"), F.max("_locked").alias("_locked"))
    skipped = F.col("_locked").isNotNull() | F.coalesce(F.col(seq) > F.col("_final"), F.lit(False))
    outcome = F.when(~F.coalesce(keyed, F.lit(False)), "failed").when(skipped, "skipped").otherwise("written")
    joined = spread_join(updates, side, KEY, "left")
    return joined.withColumn("outcome", outcome).select(*updates.columns, "outcome")


def upsert_summary(outcomes: DataFrame) -> DataFrame:
    """One row: success, skipped, failed, total."""
    outcome = F.col("outcome")
    return outcomes.agg(
        F.count_if(outcome == "written").alias("success"),
        F.count_if(outcome == "skipped").alias("skipped"),
        F.count_if(outcome == "failed").alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def folded(updates: DataFrame, seq: str, columns: Mapping[str, Column | None], key: str = KEY) -> DataFrame:
    """One row per key: for each column `_set_<name>`, a struct with its last value, null where no update sets it."""
    folds = []
    for name, condition in columns.items():
        setting = F.max_by(F.struct(F.col(name).alias("v")), F.col(seq))
        if condition is not None:
            kept = F.when(condition, F.struct(F.col(name).alias("v")))
            setting = F.max_by(kept, F.when(condition, F.col(seq)))
        folds.append(setting.alias(f"_set_{name}"))
    return split_blank_keys(updates, key)[0].groupBy(key).agg(*folds)


def merge_parts(
    target: DataFrame,
    updates: DataFrame,
    seq: str,
    columns: Mapping[str, Column | None],
    key: str = KEY,
    few: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The pieces of `upsert_merge`: the table's rows with their changes, and rows for absent keys."""
    changes = folded(updates, seq, columns, key)
    names = target.columns + [c for c in columns if c not in target.columns]
    types = {f.name: f.dataType for f in [*updates.schema.fields, *target.schema.fields]}

    def merged(df: DataFrame) -> DataFrame:
        out = [F.col(key)]
        for name in names:
            if name == key:
                continue
            old = F.col(name) if name in df.columns else F.lit(None).cast(types[name])
            if name in columns:
                change = F.col(f"_set_{name}")
                old = F.when(change.isNotNull(), change["v"].cast(types[name])).otherwise(old)
            out.append(old.alias(name))
        return df.select(*out).select(*names)

    present = _existing_keys(target, changes, key, few)
    fresh = changes.join(_build(present, few), key, "left_anti")
    return merged(target.join(_build(changes, few), key, "left")), merged(fresh)


def upsert_merge(
    target: DataFrame,
    updates: DataFrame,
    seq: str,
    columns: Mapping[str, Column | None],
    key: str = KEY,
    few: bool = False,
) -> DataFrame:
    """Set named columns by key and keep the others; an absent key makes a new row.

    `columns` maps a column to the condition under which an update sets it (None: always). "Not set" is told
    by that condition and not by null, so that null can be written too. Repeated updates of a key are folded column by column in
    `seq` order, as if applied one after the other.
    """
    updated, fresh = merge_parts(target, updates, seq, columns, key, few)
    return updated.unionByName(fresh)


def update_status(target: DataFrame, updates: DataFrame, seq: str, now: Column, extras: Sequence[str] = ()) -> DataFrame:
    """Set `status`, `updated_at` and the named extra columns."""
    stamped = updates.withColumn("updated_at", now)
    return upsert_merge(target, stamped, seq, dict.fromkeys(["status", "updated_at", *extras]))


def delete_parts(target: DataFrame, keys: DataFrame, few: bool = False) -> tuple[DataFrame, DataFrame]:
    """The pieces of `delete_rows`: what stays, and nothing new."""
    gone = keys.select("index_id", KEY).distinct()
    kept = target.join(_build(gone, few), ["index_id", KEY], "left_anti").select(*target.columns)
    return kept, target.limit(0)


def delete_rows(target: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove the videos named by (index_id, video_id)."""
    return delete_parts(target, keys)[0]


def delete_index(target: DataFrame, index_id: str) -> DataFrame:
    """Remove an index with all its videos; rows without an index stay."""
    return target.filter(~F.col("index_id").eqNullSafe(index_id))


def task_result_rows(results: DataFrame, index_id: str | None, now: Column) -> DataFrame:
    """Catalogue rows for finished tasks: a stand-in id when there is none, pending embedding only when ready."""
    given = F.col("video_id") if "video_id" in results.columns else F.lit(None).cast("string")
    return results.select(
        F.coalesce(F.nullif(given, F.lit("")), F.concat(F.lit("no-id-"), "s3_key")).alias(KEY),
        "s3_key",
        (F.col("index_id") if index_id is None else F.lit(index_id)).alias("index_id"),
        "status",
        "task_id",
        now.alias("indexed_at"),
        F.when(F.col("status") == "ready", "pending").otherwise("skipped").alias("embedding_status"),
    )


def write_task_results(
    target: DataFrame, results: DataFrame, now: Column, index_id: str | None = None, seq: str = "task_id"
) -> DataFrame:
    """Replace the rows of finished tasks; `seq` decides between results for one video."""
    rows = task_result_rows(results, index_id, now).withColumn("_seq", F.col(seq))
    return upsert_replace(target, rows, "_seq")


def embedding_changes(results: DataFrame, now: Column, seq: str = KEY) -> tuple[DataFrame, dict[str, Column | None]]:
    """Updates for embedding results, ordered by `_seq`, and the columns that they set under which condition."""
    done = F.coalesce(F.col("embedding_s3") != "", F.lit(False))
    error = F.col("error") if "error" in results.columns else F.lit("unknown")
    changes = results.select(
        KEY,
        F.col(seq).alias("_seq"),
        F.when(done, "embedded").otherwise("embedding_failed").alias("embedding_status"),
        "embedding_s3",
        error.cast("string").alias("embed_error"),
        now.alias("embedded_at"),
    )
    return changes, {"embedding_status": None, "embedding_s3": done, "embed_error": ~done, "embedded_at": None}


def apply_embedding_results(target: DataFrame, results: DataFrame, now: Column, seq: str = KEY) -> DataFrame:
    """Mark videos embedded with their vector path, or embedding_failed with the error."""
    changes, sets = embedding_changes(results, now, seq)
    return upsert_merge(target, changes, "_seq", sets)


def embedding_summary(results: DataFrame) -> DataFrame:
    """One row: success, failed, total of an embedding run."""
    done = F.coalesce(F.col("embedding_s3") != "", F.lit(False))
    return results.agg(
        F.count_if(done).alias("success"), F.count_if(~done).alias("failed"), F.count(F.lit(1)).alias("total")
    )


def lifecycle_rows(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to put, rejects) for lifecycle records: rows without an id cannot be stored."""
    if "embedding_s3_key" in records.columns:
        records = records.withColumnRenamed("embedding_s3_key", "embedding_s3")
    return split_blank_keys(records)


def persist_lifecycle(target: DataFrame, records: DataFrame, seq: str) -> DataFrame:
    """Put whole lifecycle records; nulls are plain nulls."""
    return upsert_replace(target, lifecycle_rows(records)[0], seq)


def oldest(rows: DataFrame, limit: int | None = None, after: tuple[object, str] | None = None) -> DataFrame:
    """Rows in the order of (created_at, video_id), rows without a time first: all, or `limit` after the key `after`."""
    if after is not None:
        at, key = F.lit(after[0]), F.lit(after[1])
        later = (F.col("created_at") > at) | (F.col("created_at").eqNullSafe(at) & (F.col(KEY) > key))
        rows = rows.filter(F.col("created_at").isNotNull() | (F.col(KEY) > key) if after[0] is None else later)
    return rows if limit is None else rows.orderBy(F.col("created_at").asc_nulls_first(), KEY).limit(limit)


def pending_embedding(catalog: DataFrame, limit: int | None = None, after: tuple[object, str] | None = None) -> DataFrame:
    """The videos that are ready and wait for an embedding: all, or the oldest `limit` after (created_at, video_id)."""
    return oldest(catalog.filter((F.col("status") == "ready") & (F.col("embedding_status") == "pending")), limit, after)


def by_status(catalog: DataFrame, status: str, limit: int | None = None, after: tuple[object, str] | None = None) -> DataFrame:
    """The videos with a status: all, or the oldest `limit` after (created_at, video_id)."""
    return oldest(catalog.filter(F.col("status") == status), limit, after)


def vector_path(video_id: Column) -> Column:
    return F.concat(F.lit("embeddings/"), video_id, F.lit(".npy"))


def embedding_result_rows(embedded: DataFrame, model: str) -> DataFrame:
    """Embedding output with the path of the stored vector; no path where there is an error or no vector."""
    stored = F.col("error").isNull() & (F.size("embedding") > 0)
    return embedded.select(
        KEY, "error", F.lit(model).alias("embed_model"), F.when(stored, vector_path(F.col(KEY))).alias("embedding_s3")
    )


def store_stage(records: DataFrame, now: Column) -> DataFrame:
    """Lifecycle records after the embedding stage: without a vector nothing is stored and the row stays `embedding`."""
    has_vector = F.coalesce(F.size("embedding") > 0, F.lit(False))
    return records.withColumns(
        {
            "status": F.when(has_vector, "embedded").otherwise("embedding"),
            "embedding_dim": F.when(has_vector, F.size("embedding")).otherwise(0),
            "embedding_s3": F.when(has_vector, vector_path(F.col(KEY))),
            "embedded_at": F.when(has_vector, now),
        }
    )


def served_projection(catalog: DataFrame) -> DataFrame:
    """The 14 columns of the read API, times as ISO text: missing values become '' or 0, optional ones null when empty."""
    always = {
        "video_id": "", "s3_key": "", "s3_uri": "", "index_id": "", "status": "", "embedding_status": "",
        "size_bytes": 0, "size_mb": 0.0, "created_at": "",
    }
    optional = {"indexed_at": "", "embedded_at": "", "embedding_s3": "", "duration_sec": 0.0}
    kinds = {"size_bytes": "bigint", "size_mb": "double", "duration_sec": "double"}

    def given(name: str) -> Column:
        column = F.col(name) if name in catalog.columns else F.lit(None)
        if name in catalog.columns and isinstance(catalog.schema[name].dataType, T.TimestampType):
            column = iso_text(column)
        return column.cast(kinds.get(name, "string"))

    columns = [F.coalesce(given(n), F.lit(d).cast(kinds.get(n, "string"))).alias(n) for n, d in always.items()]
    columns += [F.nullif(given(n), F.lit(d)).alias(n) for n, d in optional.items()]
    tags = F.col("tags") if "tags" in catalog.columns else F.lit(None).cast("map<string,string>")
    columns.append(F.when(F.size(tags) > 0, tags).alias("tags"))
    return catalog.select(*columns)
