"""Joins whose left side may have hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(left: DataFrame, right: DataFrame, key: str | Sequence[str], how: str) -> DataFrame:
    """Join on `key` (left, left_semi or left_anti) so that Spark can split a hot key of the left side over many tasks.

    Spark splits a skewed partition only if both sides come straight out of a shuffle for the join. A right side that was
    grouped by the same key does not: its shuffle is reused. The hash as a second key asks for a
    shuffle of its own, which costs one more pass of the right side and none of the left. A right side that
    is small enough is broadcast as ever.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = {k: f"_{k}_of_right" for k in keys}
    same = F.xxhash64(*keys) == F.xxhash64(*others.values())
    for k, other in others.items():
        same = (F.col(k) == F.col(other)) & same
    return left.join(right.withColumnsRenamed(others), same, how).drop(*others.values())
