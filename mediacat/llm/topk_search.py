"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into segments; by Cauchy and Schwarz the inner product of two segments of length w is at most
w (m1 m2 + s1 s2), with their means m and standard deviations s. Equivalently, the sum over the segments of
w ((m1 - m2)^2 + (s1 - s2)^2) is a lower bound of the squared distance, and with |p|^2 + |q|^2 - d^2 = 2 <p, q> a lower
bound of the distance is an upper bound of the product. Few long segments give a cheap coarse bound, many short ones a
closer bound; only what passes all of them is multiplied out.

Rows are dealt to cells of bounded size and queries to blocks of bounded size; every (cell, block) is one group, so neither
side is ever whole in one place. A cell returns k rows per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENTS = (4, 16)
CELL_ROWS = 8192
BLOCK_ROWS = 2048
LONG_MAX = np.iinfo(np.int64).max


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), size)


def statistics(rows: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, means and deviations of the segments of each row (the last segment takes what is left over)."""
    size = rows.shape[1]
    edges = np.linspace(0, size, min(segments, size) + 1).astype(int)
    lengths = np.diff(edges).astype(np.float64)
    sums = np.add.reduceat(rows, edges[:-1], axis=1)
    squares = np.add.reduceat(rows * rows, edges[:-1], axis=1)
    means = sums / lengths
    return lengths, means, np.sqrt(np.maximum(squares / lengths - means * means, 0.0))


def _exact(rows: np.ndarray, query: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products of whole numbers held as doubles; beyond 2^53 with Python's integers, kept within a long."""
    if safe:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array(
        [min(max(sum(int(a) * b for a, b in zip(r, whole)), -LONG_MAX - 1), LONG_MAX) for r in rows.tolist()], np.int64
    )


def cell_top(rows: np.ndarray, row_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, and the ids and scores of its k best rows with another id."""
    size = rows.shape[1]
    most = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * size
    safe = most < 2.0**52  # doubles hold all sums exactly
    levels = []
    if most < 2.0**40 and size:
        for segments in SEGMENTS:
            weights, mean, spread = statistics(rows, segments)
            _, query_mean, query_spread = statistics(queries, segments)
            # one inner product with 2 x segments terms; rounding is far below one half, the least gap between products
            levels.append((np.hstack((mean, spread)), np.hstack((query_mean * weights, query_spread * weights))))
    out = []
    for number in range(len(queries)):
        other = row_ids != query_ids[number]
        live = np.flatnonzero(other)
        if not len(live):
            continue
        threshold = None
        for of_rows, of_queries in levels:
            bound = of_rows[live] @ of_queries[number]
            if threshold is None and len(live) > k:
                seeds = live[np.argpartition(-bound, k - 1)[:k]]
                threshold = int(_exact(rows[seeds], queries[number], safe).min())
            if threshold is not None:
                live = live[bound >= threshold - 0.5]
        scores = _exact(rows[live], queries[number], safe)
        if len(live) > k:
            last = np.partition(scores, len(scores) - k)[len(scores) - k]
            near = scores >= last
            live, scores = live[near], scores[near]
        order = sorted(range(len(live)), key=lambda i: (-int(scores[i]), int(row_ids[live[i]])))[:k]
        out.append((number, row_ids[live[order]], scores[order]))
    return out


def _group(k: int) -> Callable:
    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        size = key[2].as_py()
        found = []
        if rows.num_rows and queries.num_rows:
            found = cell_top(
                _matrix(rows.column("v"), size), rows.column("vec_id").to_numpy(),
                _matrix(queries.column("v"), size), queries.column("query_id").to_numpy(), k,
            )
        numbers = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64) if found else np.empty(0, np.int64)
        ids = queries.column("query_id").to_numpy()[numbers] if len(numbers) else np.empty(0, np.int64)
        marks = queries.column("mark").to_numpy()[numbers] if len(numbers) else np.empty(0, np.int64)
        empty = [np.empty(0, np.int64)]
        return pa.table({
            "query_id": pa.array(ids, pa.int64()), "mark": pa.array(marks, pa.int64()),
            "vec_id": pa.array(np.concatenate([f[1] for f in found] or empty), pa.int64()),
            "score": pa.array(np.concatenate([f[2] for f in found] or empty), pa.int64()),
        })

    return run


def _floor(x: Column) -> Column:
    """Floor as a double; from 2^53 on every double is whole already, and beyond 1e300 counts as that."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(F.greatest(F.least(x, F.lit(1e300)), F.lit(-1e300)))


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and v, the floor of `scale` times each component; vectors that are null, or hold null, NaN or an infinity, and rows without id are left out."""
    fine = F.expr("embedding is not null and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        .select("vec_id", F.transform("embedding", lambda x: _floor(x * F.lit(float(scale)))).alias("v"))
    )


def top_k(
    vectors: DataFrame, queries: DataFrame | None = None, k: int = 10, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The k rows with the highest integer inner product for every query, and all if there are fewer.

    vectors: vec_id long, embedding array of numbers; other columns are ignored. queries: the same shape; by default the
    rows of `vectors` whose id is divisible by 100. Returns query_id, rank (from 1), vec_id, score; ties go to the
    smaller vec_id. A row with the query's id is its own and no candidate; rows that repeat an id and a vector are all
    candidates, but ask once; a repeated id with another vector asks once for each vector.
    Only vectors of one length are compared; empty vectors have the product 0 with each other. A product
    beyond a long is kept at the end of its range. An empty table gives no rows.
    """
    rows = quantised(vectors)
    asked = quantised(vectors.where(F.col("vec_id") % 100 == 0) if queries is None else queries)
    asked = asked.select(F.col("vec_id").alias("query_id"), "v", F.xxhash64("v").alias("mark")).dropDuplicates(["query_id", "mark"])
    cells = max(1, -(-vectors.count() // cell_rows))
    blocks = max(1, -(-asked.count() // block_rows))
    size = F.size("v").alias("size")
    left = rows.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(cells)).alias("cell"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        size, "vec_id", "v",
    )
    right = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"),
        size, "query_id", "mark", "v",
    )
    key = ["cell", "block", "size"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_group(k), "query_id long, mark long, vec_id long, score long")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
