"""A trained index for approximate vector search: coarse cells, residual product codes, exact rerank.

Unit vectors are dealt to the cell of the nearest of some centroids; what is left of each (the residual) is cut into parts,
and each part is replaced by the number of the nearest of a few words. A search reads the codes of the probed cells alone, a
byte per part, and estimates the cosine from the query's products with centroids and words (asymmetric: the query is
not coded). The best `rerank` rows per query are then scored exactly.

Centroids and words come from a bounded sample of the table (`SAMPLE_ROWS` rows, by a hash of the row's key); every row is
indexed. Ties in the nearest centroid or word, after rounding to nine places, go to the smaller number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from mediacat.operators import search as exact
from mediacat.operators.search import HIT_COLUMNS, QueryBlock, Search

SAMPLE_ROWS = 65_536
MAX_CELLS, MAX_WORDS = 65_536, 256
NEAREST_DIGITS = 9
KEY = ["clip_id", "modality"]


@dataclass(frozen=True)
class VectorIndex:
    """centroids [cells, dim]; words: for each part its words [words, length of the part]."""

    centroids: np.ndarray
    words: tuple[np.ndarray, ...]

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    @property
    def edges(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([w.shape[1] for w in self.words])))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre of each row."""
    closeness = rows @ centres.T - (centres * centres).sum(axis=1) / 2
    return np.argmax(np.round(closeness, NEAREST_DIGITS), axis=1)


def centres(rows: np.ndarray, count: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from the first `count` rows; a centre without rows stays where it is."""
    found = rows[:count].copy()
    for _ in range(rounds):
        own = nearest(rows, found)
        size = np.bincount(own, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, own, rows)
        found = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], found)
    return found


def sample(vectors: DataFrame, dim: int, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Unit vectors of the `rows` rows with the smallest hashes of their keys; all rows of a smaller table.

    Rows whose hash is far too great are left out before the sort, so what any task sends is near the share of the table it
    holds of the sample.
    """
    usable = exact.usable_vectors(vectors, dim)
    key = F.md5(F.concat_ws(":", *KEY))
    share = min(1.0, 1.5 * rows / max(1, usable.count()))
    small = usable.withColumn("_key", key).where(F.substring("_key", 1, 8) <= f"{int(share * 0xFFFFFFFF):08x}")
    chosen = small.orderBy("_key", *KEY).limit(rows).select("embedding").toArrow()
    out = [exact.batch_matrix(b)[1] for b in chosen.to_batches() if b.num_rows]
    return np.concatenate(out) if out else np.empty((0, dim))


def fit(
    vectors: DataFrame, dim: int, cells: int = 256, parts: int = 32, words: int = 256, sample_rows: int = SAMPLE_ROWS, rounds: int = 8
) -> VectorIndex:
    """Centroids and words from a sample of the table. A sample smaller than `cells` or `words` gives as many as it has rows."""
    if not (1 <= cells <= MAX_CELLS and 1 <= words <= MAX_WORDS and 1 <= parts <= dim):
        raise ValueError("cells, words or parts out of range")
    rows = sample(vectors, dim, sample_rows)
    if not len(rows):
        raise ValueError("no vector to learn from")
    centroids = centres(rows, cells, rounds)
    residual = rows - centroids[nearest(rows, centroids)]
    return VectorIndex(centroids, tuple(centres(np.ascontiguousarray(p), words, rounds) for p in np.array_split(residual, parts, axis=1)))


def encode(index: VectorIndex, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and codes of unit vectors."""
    cell = nearest(matrix, index.centroids)
    residual = matrix - index.centroids[cell]
    codes = [nearest(residual[:, a:b], w) for a, b, w in zip(index.edges, index.edges[1:], index.words)]
    return cell.astype(np.int32), np.stack(codes, axis=1).astype(np.uint8)


def index_rows(vectors: DataFrame, index: VectorIndex) -> DataFrame:
    """Every usable vector with its `cell` and `code`; zero vectors and vectors with nulls are left out, as in a search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch, matrix = exact.batch_matrix(batch)
                cell, codes = encode(index, matrix)
                batch = batch.append_column("cell", pa.array(cell))
                yield batch.append_column("code", pa.array([c.tobytes() for c in codes], pa.binary()))

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType())])
    return exact.usable_vectors(vectors, index.dim).mapInArrow(run, schema)


def write_index(vectors: DataFrame, index: VectorIndex, folder: str) -> None:
    """Store rows (by cell) and model below `folder`. Large cells are split into several files by AQE.

    The model, a few megabytes at most, becomes two tables: centroids (cell, centroid) and words (part, word, vector).
    """
    spark = vectors.sparkSession
    index_rows(vectors, index).hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{folder}/rows")
    centroids = [(i, c.tolist()) for i, c in enumerate(index.centroids)]
    words = [(p, i, w.tolist()) for p, part in enumerate(index.words) for i, w in enumerate(part)]
    for rows, schema, name in (
        (centroids, "cell int, centroid array<double>", "centroids"), (words, "part int, word int, vector array<double>", "words"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_index(spark: SparkSession, folder: str) -> tuple[DataFrame, VectorIndex]:
    centroids = spark.read.parquet(f"{folder}/centroids").orderBy("cell").collect()
    parts: dict[int, list] = {}
    for row in spark.read.parquet(f"{folder}/words").orderBy("part", "word").collect():
        parts.setdefault(row["part"], []).append(row["vector"])
    model = VectorIndex(np.array([r["centroid"] for r in centroids]), tuple(np.array(parts[p]) for p in sorted(parts)))
    return spark.read.parquet(f"{folder}/rows"), model


def probe(index: VectorIndex, block: QueryBlock, probes: int) -> QueryBlock:
    """Per query the `probes` cells whose centroids are nearest."""
    closeness = block.matrix @ index.centroids.T - (index.centroids * index.centroids).sum(axis=1) / 2
    chosen = np.argsort(-np.round(closeness, NEAREST_DIGITS), axis=1, kind="stable")[:, :probes]
    return replace(block, probes=[np.sort(c) for c in chosen])


def _estimates(index: VectorIndex, block: QueryBlock, rerank: int, query_type: pa.DataType) -> Callable:
    """Per task and query the `rerank` rows with the best estimates, ties by key."""
    near = block.matrix @ index.centroids.T
    tables = [block.matrix[:, a:b] @ w.T for a, b, w in zip(index.edges, index.edges[1:], index.words)]
    probed = np.zeros(near.shape, bool)
    for q, cells in enumerate(block.probes):
        probed[q, cells] = True

    def best(hits: pa.Table) -> pa.Table:
        return hits.sort_by([("estimate", "descending"), *((k, "ascending") for k in KEY)]).slice(0, rerank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, pa.Table] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(cell), -1)
            for q in range(len(block.ids)):
                rows = np.flatnonzero(probed[q, cell])
                if not rows.size:
                    continue
                estimate = near[q, cell[rows]]
                for part, table in enumerate(tables):
                    estimate = estimate + table[q, codes[rows, part]]
                estimate = np.round(estimate, exact.SCORE_DIGITS) + 0.0
                short = exact._shortlist(estimate, np.arange(rows.size), rerank)
                part = pa.Table.from_batches([batch.select(KEY).take(pa.array(rows[short]))])
                part = part.append_column("estimate", pa.array(estimate[short]))
                found[q] = best(part if q not in found else pa.concat_tables([found[q], part]))
        for q, hits in found.items():
            hits = hits.add_column(0, "query_id", pa.array([block.ids[q]] * hits.num_rows, query_type))
            yield from hits.combine_chunks().to_batches()

    return run


def _scored(block: QueryBlock, query_type: pa.DataType, floor: float) -> Callable:
    """Exact scores of the rows for the queries listed with them in `_for`."""
    position = {i: q for q, i in enumerate(block.ids)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            batch, matrix = exact.batch_matrix(batch)
            lists = batch.column("_for").to_pylist()
            row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            q = np.array([position[i] for x in lists for i in x], np.int64)
            scores = np.round(np.einsum("ij,ij->i", matrix[row], block.matrix[q]), exact.SCORE_DIGITS) + 0.0
            keep = np.flatnonzero(scores >= floor)
            hits = pa.Table.from_batches([batch.select(HIT_COLUMNS).take(pa.array(row[keep]))])
            hits = hits.append_column("score", pa.array(scores[keep]))
            hits = hits.add_column(0, "query_id", pa.array([block.ids[i] for i in q[keep]], query_type))
            yield from hits.combine_chunks().to_batches()

    return run


def search_index(
    rows: DataFrame, index: VectorIndex, queries: DataFrame, options: Search = Search(),
    allowed: DataFrame | None = None, probes: int = 64, rerank: int = 100,
) -> DataFrame:
    """Like `search.search` over the rows of an index; hits outside the probed cells or the best `rerank` estimates are missed.

    Hits are clips (group_by="clip"). The first scan reads key, cell and code of the probed cells; at most `rerank` rows per task and query
    leave it, and as many per query go on. The second scan scores these against their vectors, so returned scores are exact. With all
    cells probed and `rerank` no less than the rows, the answer is the exact one.
    """
    if options.group_by != "clip":
        raise ValueError("an index finds clips")
    if rerank < options.rows:
        raise ValueError("rerank must cover the limit")

    def find(block: QueryBlock) -> DataFrame:
        block = probe(index, block, probes)
        wanted = sorted({int(c) for cells in block.probes for c in cells})
        kind = queries.schema["query_id"]
        query_type = to_arrow_type(kind.dataType)
        probed = rows if len(wanted) == len(index.centroids) else rows.filter(F.col("cell").isin(wanted))
        probed = exact.eligible(probed, options, allowed)
        key = [rows.schema[k] for k in KEY]
        estimate = T.StructType([T.StructField("query_id", kind.dataType), *key, T.StructField("estimate", T.DoubleType())])
        near = probed.select(*KEY, "cell", "code").mapInArrow(_estimates(index, block, rerank, query_type), estimate)
        order = Window.partitionBy("query_id").orderBy(F.desc("estimate"), *KEY)
        survivors = near.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= rerank)
        lists = survivors.groupBy(*(F.col(k).alias(f"_{k}") for k in KEY)).agg(F.collect_set("query_id").alias("_for"))  # no longer than the block
        same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY))
        listed = probed.join(lists, same).select(*HIT_COLUMNS, "embedding", "_for")
        schema = exact._hit_schema(rows, queries)
        hits = listed.mapInArrow(_scored(block, query_type, options.floor), schema)
        by = Window.partitionBy("query_id", "clip_id").orderBy(F.desc("score"), "modality", "start_sec", "end_sec")
        hits = hits.withColumn("_rn", F.row_number().over(by)).filter(F.col("_rn") == 1).drop("_rn")
        after = {**(options.after or {}), **block.cursors}
        ranked = exact._rank(hits, "clip_id", replace(options, after=after), block)
        return ranked.withColumn("confidence", exact.confidence(F.col("score"), options.thresholds))

    return exact._block_by_block(queries, find)


def recall(approximate: DataFrame, true: DataFrame) -> DataFrame:
    """Per query the share of the true hits (query_id, clip_id) that the approximate search found."""
    got = approximate.select("query_id", "clip_id", F.lit(1).alias("_got"))
    joined = true.select("query_id", "clip_id").join(got, ["query_id", "clip_id"], "left")
    return joined.groupBy("query_id").agg((F.count("_got") / F.count(F.lit(1))).alias("recall"))
