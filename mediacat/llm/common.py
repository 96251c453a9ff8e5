"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.session import apply_result_settings, run_dir

LAST_ID = np.iinfo(np.int64).max
"""Stands for a null id where ids are compared: after all others."""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_result_settings(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a new folder below the shared folder and read it back: later stages do not depend on executors."""
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    """A text as bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def held_out(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the bytes of `column` stay near `max_bytes`; one larger row is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string column end to end, and the offsets of its rows (nulls are empty)."""
    values = column.to_pylist()
    data = b"".join(v if isinstance(v, bytes) else v.encode() if v else b"" for v in values)
    sizes = np.fromiter((len(v) if isinstance(v, bytes) else len(v.encode()) if v else 0 for v in values), np.int64, len(values))
    return np.frombuffer(data, np.uint8), np.concatenate(([0], np.cumsum(sizes)))


def ids(column: pa.Array) -> np.ndarray:
    """Ids as int64, null as `LAST_ID`."""
    return pc.fill_null(column.cast(pa.int64()), int(LAST_ID)).to_numpy(zero_copy_only=False)


def width(spark: SparkSession) -> int:
    """Partitions of a shuffle in this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected links.

    edges: columns u, v (long). Returns node, root (smallest node of its component) for every node with a link.
    Large-star and small-star rounds until nothing changes: every round keeps one row per link at most, minima are
    partial aggregates, and each step is a written table, so a hub's links are split by AQE in the join and a lost
    executor costs one step.
    """

    def oriented(df: DataFrame) -> DataFrame:
        return (
            df.where("u <> v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct()
        )

    def signature(df: DataFrame) -> tuple:
        row = df.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1_000_000_007))), F.lit(0)).alias("s"),
            F.coalesce(F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(998_244_353))), F.lit(0)).alias("t"),
        ).first()
        return row["n"], row["s"], row["t"]

    links = written(oriented(edges), "links")
    before = signature(links)
    while before[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large")
        starred = written(
            oriented(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))), "links"
        )
        least = written(starred.groupBy("u").agg(F.min("v").alias("m")), "small")
        linked = starred.join(least, "u")
        links = written(
            oriented(linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v")))),
            "links",
        )
        after = signature(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
