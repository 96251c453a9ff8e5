"""How many partitions the state of a stream is dealt over."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_ROWS = 8192


def partitions_for(rows: int, most: int) -> int:
    """sqrt(rows / STATE_ROWS), `most` at most.

    Every task of a stateful stream reports a few figures for each partition of each state store in its stage, its own or not, so what the driver
    is sent grows with the square of the partitions. With the root of the rows it grows as the rows do, and a partition's state as their root.
    """
    return max(1, min(most, math.ceil(math.sqrt(rows / STATE_ROWS))))


@contextmanager
def state_partitions(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Streams that are started inside deal their state by the rows of all deliveries; the session's own width is the most, and is set again.

    A stream keeps the width that it was first started with in its checkpoint. rows: None leaves everything as it is.
    """
    if rows is None:
        yield
        return
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, partitions_for(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)
