"""Retention report: what the storage rules say about each object. Nothing is moved or deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediacat.schemas import RETENTION_RULES

MAX_RULES = 1000  # an object store accepts at most this many rules


def retention_plan(
    objects: DataFrame, now: Column, rules: Sequence[tuple[str, str, int, str]] = RETENTION_RULES
) -> DataFrame:
    """Objects with `age_days` and the `action` due: of all rules for bucket and prefix, the one with most days.

    The rules are a literal inside the expression, so the objects are read once and never shuffled.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("last_modified")) / 86_400)
    due = F.greatest(
        F.lit(None).cast("struct<days:int,action:string>"),
        *[
            F.when(
                (F.col("bucket") == bucket) & F.col("s3_key").startswith(prefix) & (F.col("age_days") >= days),
                F.struct(F.lit(days).alias("days"), F.lit(action).alias("action")),
            )
            for bucket, prefix, days, action in rules
        ],
    )
    return objects.withColumn("age_days", age).withColumn("action", F.coalesce(due["action"], F.lit("KEEP")))


def retention_bytes(plan: DataFrame) -> DataFrame:
    """Objects and bytes per bucket and action."""
    return plan.groupBy("bucket", "action").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("size_bytes").alias("bytes")
    )
