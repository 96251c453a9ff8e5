"""Collects the registered queries: a function (spark, sf_dir) -> DataFrame and, where it can be said, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mediacat.session import apply_result_settings

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFunction
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(*ids: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a query under its function's name; `ids` are the inventory entries it exercises."""

    def register(fn: QueryFunction) -> QueryFunction:
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__} exists already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_result_settings(spark), sf_dir.rstrip("/"))

        REGISTRY[fn.__name__] = Query(run, sql, ids)
        return fn

    return register


def registered() -> dict[str, Query]:
    from mediacat.plans import (  # noqa: F401 - importing a module registers its queries
        catalog_queries,
        metadata_queries,
        model_queries,
        object_queries,
        search_queries,
        stream_queries,
        task_queries,
    )

    return dict(REGISTRY)
