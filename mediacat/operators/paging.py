"""Lookups and pages over the catalogue."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.operators.catalog import KEY
from mediacat.operators.running import row_positions
from mediacat.schemas import LIST_LIMIT, PAGE_SIZE

# A page that ends within this many rows is found by a bounded top-n; deeper pages rank the table.
SHALLOW_ROWS = 10_000


def clamp_limit(value: object, default: int, maximum: int) -> int:
    """For requests from outside: the limit, or the default when it is not an integer in 1..maximum. Operators take limits as they are."""
    if value is None or not re.fullmatch(r"[+-]?[0-9]+", str(value)):
        return default
    return int(value) if 0 < int(value) <= maximum else default


def get_video(catalog: DataFrame, video_id: str, index_id: str | None = None) -> DataFrame:
    """The row of one video, none if it is absent."""
    found = catalog.filter(F.col(KEY) == video_id)
    return found if index_id is None else found.filter(F.col("index_id") == index_id)


def whole_limit(limit: int) -> int:
    if not isinstance(limit, int) or limit < 1:
        raise ValueError(f"a limit is a whole number from 1: {limit!r}")
    return limit


def list_videos(catalog: DataFrame, limit: int = LIST_LIMIT, last_key: str | None = None) -> DataFrame:
    """The page of `limit` videos after `last_key` in key order."""
    rows = catalog if not last_key else catalog.filter(F.col(KEY) > last_key)
    return rows.orderBy(KEY).limit(whole_limit(limit))


def page_info(page: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """One row with the page's row count and the key to continue after, null on a page that is not full."""
    full = whole_limit(limit)
    counted = page.agg(F.count(F.lit(1)).alias("count"), F.max(KEY).alias("last"))
    return counted.select("count", F.when(F.col("count") == full, F.col("last")).alias("last_evaluated_key"))


def numbered_page(rows: DataFrame, order: Sequence[str], page: int = 1, page_limit: int = PAGE_SIZE) -> DataFrame:
    """Page number `page` of the rows in a unique order."""
    first, last = (page - 1) * page_limit, page * page_limit
    if last <= SHALLOW_ROWS:
        return rows.orderBy(*order).offset(first).limit(page_limit)
    position = F.col("_position")
    ranked = row_positions(rows, order, "_position")
    return ranked.filter((position > first) & (position <= last)).drop("_position")


def list_index_videos(catalog: DataFrame, index_id: str, page: int = 1, page_limit: int = PAGE_SIZE) -> DataFrame:
    """One numbered page of an index's videos."""
    return numbered_page(catalog.filter(F.col("index_id") == index_id), [KEY], page, page_limit)


def index_totals(catalog: DataFrame) -> DataFrame:
    """One row per index: videos, embedded videos, first and last creation."""
    return catalog.filter(F.col("index_id").isNotNull()).groupBy("index_id").agg(
        F.count(F.lit(1)).alias("videos"),
        F.count_if(F.col("embedding_status") == "embedded").alias("embedded"),
        F.min("created_at").alias("first_created_at"),
        F.max("created_at").alias("last_created_at"),
    )


def list_indexes(catalog: DataFrame, page: int = 1, page_limit: int = PAGE_SIZE) -> DataFrame:
    """One numbered page of the indexes."""
    return numbered_page(index_totals(catalog), ["index_id"], page, page_limit)


def get_index(catalog: DataFrame, index_id: str) -> DataFrame:
    return index_totals(catalog.filter(F.col("index_id") == index_id))
