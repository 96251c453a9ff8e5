"""Vector search: exact top-k by cosine similarity, and an approximate variant that reads part of the table.

Scoring is one scan of the vector table. Each task multiplies its Arrow batches with the block of query vectors and
keeps its own best rows per query, so what leaves a task is at most queries x limit rows however many vectors it read.
Scores are rounded before ranking and ties go to the smaller id: results do not depend on how
the table is split into tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from mediacat.operators.joins import spread_join
from mediacat.operators.paging import whole_limit
from mediacat.schemas import DEFAULT_MODALITIES, SEARCH_LIMIT
from mediacat.session import run_dir

# The query block is shipped to every task, so its size is checked; more queries are searched block after block.
MAX_BLOCK_BYTES = 32 << 20
FEW_QUERIES, MAX_DIM = 256, 16_384  # as many queries of such a length are collected without being measured first
MAX_SCORE_BYTES = 64 << 20  # scores that a task holds at a time
SCORE_DIGITS = 6
CURSOR = ("_score", "_last", "_seen")
HIT_COLUMNS = ["clip_id", "video_id", "modality", "start_sec", "end_sec"]

# Score needed for each confidence word; callers may pass their own.
THRESHOLDS = {"low": 0.0, "medium": 0.15, "high": 0.30}


@dataclass(frozen=True)
class Search:
    """Options of a search."""

    limit: int | None = None
    group_by: str = "clip"
    threshold: str | None = "medium"
    modalities: Sequence[str] | None = DEFAULT_MODALITIES
    after: Mapping[object, tuple[float, object, int]] | None = None  # query id to (score, id, rank) of the last hit seen
    index_id: str | None = None  # search the vectors of one index; reads its folder only where the table is partitioned by it
    thresholds: Mapping[str, float] = field(default_factory=lambda: THRESHOLDS)

    def __post_init__(self) -> None:
        if self.group_by not in ("clip", "video"):
            raise ValueError(f"unknown grouping: {self.group_by}")
        if self.threshold is not None and self.threshold not in self.thresholds:
            raise ValueError(f"unknown threshold: {self.threshold}")
        if self.limit is not None:
            whole_limit(self.limit)

    @property
    def rows(self) -> int:
        return SEARCH_LIMIT if self.limit is None else self.limit

    @property
    def floor(self) -> float:
        return -np.inf if self.threshold is None else float(self.thresholds[self.threshold])


@dataclass(frozen=True)
class QueryBlock:
    """Query ids with their unit vectors, row by row; bounded by MAX_BLOCK_BYTES.

    `probes` holds the cells to look into per query, or None to look everywhere; `cursors` the last hits seen.
    """

    ids: list
    matrix: np.ndarray
    probes: list[np.ndarray] | None = None
    cursors: Mapping[object, tuple[float, object, int]] = field(default_factory=dict)

    @property
    def dim(self) -> int:
        return self.matrix.shape[1]


def _block(rows: list) -> QueryBlock:
    vectors = [r["embedding"] for r in rows]
    lengths = {len(v) if v is not None else 0 for v in vectors}
    if len(lengths) != 1 or 0 in lengths:
        raise ValueError("query vectors must have one length")
    matrix = np.array(vectors, dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    if not np.all(norms > 0):
        raise ValueError("query vectors must not be zero or contain nulls")
    ids = [r["query_id"] for r in rows]
    if len(set(ids)) != len(ids) or None in ids:
        raise ValueError("query_id must be unique and not null")
    seen = {r["query_id"]: tuple(r[c] for c in CURSOR) for r in rows if CURSOR[0] in r and r[CURSOR[0]] is not None}
    return QueryBlock(ids, matrix / norms, cursors=seen)


def query_blocks(queries: DataFrame, max_bytes: int = MAX_BLOCK_BYTES) -> Iterator[QueryBlock]:
    """The queries as blocks of at most `max_bytes`; no more than that is ever collected at a time."""
    queries = queries.select("query_id", "embedding", *[c for c in CURSOR if c in queries.columns])
    few = min(FEW_QUERIES, max(1, max_bytes // (8 * MAX_DIM)))
    short = F.when(F.size("embedding") <= MAX_DIM, F.col("embedding"))
    rows = queries.withColumn("embedding", short).limit(few + 1).collect()
    if len(rows) <= few and all(r["embedding"] is not None for r in rows):
        if rows:
            yield _block(rows)
        return
    size = queries.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("query_id").alias("ids"),
        F.min(F.size("embedding")).alias("low"),
        F.max(F.size("embedding")).alias("high"),
        F.count_if(F.col("embedding").isNull()).alias("nulls"),
    ).first()
    if size["ids"] != size["rows"]:
        raise ValueError("query_id must be unique and not null")
    if size["low"] != size["high"] or size["low"] < 1 or size["nulls"]:
        raise ValueError("query vectors must have one length")
    per_block = max(1, max_bytes // (8 * size["high"]))
    last = None
    for _ in range(0, size["rows"], per_block):
        rest = queries if last is None else queries.filter(F.col("query_id") > F.lit(last))
        rows = rest.orderBy("query_id").limit(per_block).collect()
        yield _block(rows)
        last = rows[-1]["query_id"]


def usable_vectors(vectors: DataFrame, dim: int) -> DataFrame:
    return vectors.filter(F.size("embedding") == dim)


def vector_rejects(vectors: DataFrame, dim: int) -> DataFrame:
    """Rows that cannot be scored: no vector, or one of another length."""
    bad = F.col("embedding").isNull() | (F.size("embedding") != dim)
    return vectors.filter(bad).withColumn("vector_dim", F.coalesce(F.size("embedding"), F.lit(0)))


def batch_matrix(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows with a complete, non-zero vector and their unit vectors as a float64 matrix."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    dim = len(column[0])
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = flat.reshape(-1, dim)
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    good = np.isfinite(norms) & (norms > 0)  # a null element arrives as NaN
    if not good.all():
        batch = batch.filter(pa.array(good))
        matrix, norms = matrix[good], norms[good]
    return batch, matrix / norms[:, None]


def batch_scores(matrix: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return np.round(matrix @ queries.T, SCORE_DIGITS) + 0.0  # + 0.0 turns -0.0 into 0.0


def _passing(
    batch: pa.RecordBatch, scores: np.ndarray, q: int, block: QueryBlock, floor: float, cursor: tuple | None
) -> np.ndarray:
    """Positions of the batch's rows that are hits of query `q`."""
    keep = scores >= floor
    if block.probes is not None:
        keep &= np.isin(batch.column("cell").to_numpy(), block.probes[q])
    if cursor is not None:
        score, last = cursor
        ids = batch.column("clip_id")
        behind = pc.greater(ids, pa.scalar(last, ids.type)).to_numpy(zero_copy_only=False)
        keep &= (scores < score) | ((scores == score) & behind)
    return np.flatnonzero(keep)


def _most_repeats(ids: pa.Array) -> int:
    """How often the most frequent id occurs; so many rows more are needed to be sure of enough distinct ids."""
    return int(np.bincount(ids.dictionary_encode().indices.to_numpy()).max()) if len(ids) else 1


def _ordered_hits(batch: pa.RecordBatch, rows: np.ndarray, scores: np.ndarray, query: pa.Array) -> pa.Table:
    hits = pa.Table.from_batches([batch.select(HIT_COLUMNS).take(pa.array(rows))])
    hits = hits.append_column("score", pa.array(scores)).add_column(0, "query_id", query)
    return _sorted_hits(hits)


def _sorted_hits(hits: pa.Table) -> pa.Table:
    return hits.sort_by([("score", "descending"), ("clip_id", "ascending"), ("modality", "ascending")])


def _first_rows(table: pa.Table, column: str) -> np.ndarray:
    """Position of the first row of each distinct value."""
    codes = table[column].combine_chunks().dictionary_encode().indices.to_numpy()
    return np.unique(codes, return_index=True)[1]


def _shortlist(scores: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """Rows that can be among the best `limit`, ties of the last score included."""
    if rows.size <= limit:
        return rows
    least = -np.partition(-scores[rows], limit - 1)[limit - 1]
    return rows[scores[rows] >= least]


def _query_chunks(block: QueryBlock, rows: int) -> Iterator[tuple[range, np.ndarray]]:
    """The block in pieces whose scores against a batch of `rows` stay within MAX_SCORE_BYTES."""
    step = max(1, MAX_SCORE_BYTES // (8 * max(1, rows)))
    for start in range(0, len(block.ids), step):
        yield range(start, min(start + step, len(block.ids))), block.matrix[start : start + step]


def _top_rows(block: QueryBlock, options: Search, query_type: pa.DataType, by: str, single: bool) -> Callable:
    """Per task and query the best clips or videos, each with its best row.

    The task that holds the best row of a winner ranks it at least as high as the whole table does, so no winner is lost.
    Where a clip has a single row, rows up to the cursor are left out here. Otherwise a row behind the cursor may belong to one that
    was seen already by a better row in another task, so those up to the cursor are found again.
    """
    cursors = dict(options.after or {})
    limits = [options.rows + (0 if single or i not in cursors else cursors[i][2]) for i in block.ids]
    after = {i: cursor[:2] for i, cursor in cursors.items()} if single else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, pa.Table] = {}
        least = np.full(len(block.ids), options.floor)  # rises to the last score that still counts
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch, matrix = batch_matrix(batch)
            repeats = _most_repeats(batch.column(by))
            for part, queries in _query_chunks(block, len(matrix)):
                scores = batch_scores(matrix, queries)
                for column in np.flatnonzero((scores >= least[part.start : part.stop]).any(axis=0)):
                    q, mine = part.start + column, scores[:, column]
                    rows = _passing(batch, mine, q, block, least[q], after.get(block.ids[q]))
                    limit = limits[q]
                    rows = _shortlist(mine, rows, limit * repeats)
                    if rows.size == 0:
                        continue
                    hits = _ordered_hits(batch, rows, mine[rows], pa.array([block.ids[q]] * rows.size, query_type))
                    if q in best:
                        hits = _sorted_hits(pa.concat_tables([best[q], hits]))
                    firsts = hits.take(pa.array(np.sort(_first_rows(hits, by))))
                    best[q] = firsts.sort_by([("score", "descending"), (by, "ascending")]).slice(0, limit)
                    if best[q].num_rows == limit:
                        least[q] = best[q]["score"][limit - 1].as_py()
        for hits in best.values():
            yield from hits.combine_chunks().to_batches()

    return run


def _counted(block: QueryBlock, options: Search, query_type: pa.DataType) -> Callable:
    """Per batch the hits of each video for the queries that are listed with it in `_for`."""
    position = {i: q for q, i in enumerate(block.ids)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch, matrix = batch_matrix(batch)
            lists = batch.column("_for")
            named = lists.flatten().dictionary_encode()
            wanted = np.array([position[i] for i in named.dictionary.to_pylist()], np.int64)[named.indices.to_numpy()]
            owner = np.repeat(np.arange(len(matrix)), pc.list_value_length(lists).to_numpy())
            videos = batch.column("video_id").dictionary_encode()
            video = videos.indices.to_numpy().astype(np.int64)
            for part, queries in _query_chunks(block, len(matrix)):
                here = (wanted >= part.start) & (wanted < part.stop)
                rows, q = owner[here], wanted[here]
                passing = batch_scores(matrix, queries)[rows, q - part.start] >= options.floor
                if block.probes is not None:
                    cells = batch.column("cell").to_numpy()[rows]
                    for one in np.unique(q):
                        passing &= (q != one) | np.isin(cells, block.probes[one])
                pairs, hits = np.unique(video[rows[passing]] * len(block.ids) + q[passing], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.ids[i] for i in pairs % len(block.ids)], query_type),
                        videos.dictionary.take(pa.array(pairs // len(block.ids))),
                        pa.array(hits.astype(np.int64)),
                    ],
                    names=["query_id", "video_id", "hits"],
                )

    return run


def _with_hits(winners: DataFrame, rows: DataFrame, block: QueryBlock, options: Search, query_type: pa.DataType) -> DataFrame:
    """The winning videos with the number of their vectors that pass: a second scan, which scores the winners' vectors only."""
    key = T.StructType([winners.schema["query_id"], winners.schema["video_id"], T.StructField("hits", T.LongType())])
    lists = winners.groupBy("video_id").agg(F.collect_list("query_id").alias("_for"))  # no longer than the block
    listed = spread_join(rows, lists, "video_id", "left").filter(F.col("_for").isNotNull())
    parts = listed.select("video_id", "embedding", "_for", *([] if block.probes is None else ["cell"]))
    counts = parts.mapInArrow(_counted(block, options, query_type), key).groupBy("query_id", "video_id")
    return winners.join(counts.agg(F.sum("hits").alias("hits")), ["query_id", "video_id"])


def confidence(score: Column, thresholds: Mapping[str, float] = THRESHOLDS) -> Column:
    """Word of the highest threshold the score reaches, 'none' below all."""
    word = F.lit("none")
    for name, least in sorted(thresholds.items(), key=lambda item: item[1]):
        word = F.when(score >= least, name).otherwise(word)
    return word


def _rank(hits: DataFrame, by: str, options: Search, block: QueryBlock) -> DataFrame:
    """Best rows per query, after the cursor; ranks go on from page to page.

    The limit is applied before the shuffle as well, so one query stays small.
    """
    window = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc(by))
    rank = F.row_number().over(window)
    cursors = [(i, *options.after[i]) for i in block.ids if i in options.after] if options.after else []
    if not cursors:
        return hits.withColumn("rank", rank).filter(F.col("rank") <= options.rows)
    fields = [hits.schema["query_id"], T.StructField("_score", T.DoubleType())]
    fields += [T.StructField("_last", hits.schema[by].dataType), T.StructField("_seen", T.IntegerType())]
    table = hits.sparkSession.createDataFrame(cursors, T.StructType(fields))
    # one row per query of the block, whose size is checked
    rows = hits.join(F.broadcast(table), "query_id", "left")
    behind = (F.col("score") < F.col("_score")) | ((F.col("score") == F.col("_score")) & (F.col(by) > F.col("_last")))
    rows = rows.filter(F.col("_score").isNull() | behind).withColumn("rank", rank)
    rows = rows.filter(F.col("rank") <= options.rows)
    shifted = rows.withColumn("rank", F.col("rank") + F.coalesce("_seen", F.lit(0)))
    return shifted.drop("_score", "_last", "_seen")


def eligible(rows: DataFrame, options: Search, allowed: DataFrame | None) -> DataFrame:
    """The rows that a search may find, whatever their vectors."""
    if options.index_id is not None:
        rows = rows.filter(F.col("index_id") == options.index_id)
    if options.modalities is not None:
        rows = rows.filter(F.col("modality").isin(*options.modalities))
    if allowed is not None:
        rows = spread_join(rows, allowed.select("video_id").distinct(), "video_id", "left_semi")
    return rows


def _candidates(vectors: DataFrame, block: QueryBlock, options: Search, allowed: DataFrame | None) -> DataFrame:
    """The vectors to score: filters come first, so that they reach the scan."""
    return eligible(usable_vectors(vectors, block.dim), options, allowed)


def _hit_schema(vectors: DataFrame, queries: DataFrame) -> T.StructType:
    query = T.StructField("query_id", queries.schema["query_id"].dataType)
    fields = [T.StructField(c, vectors.schema[c].dataType) for c in HIT_COLUMNS]
    return T.StructType([query, *fields, T.StructField("score", T.DoubleType())])


def _search_block(
    vectors: DataFrame, queries: DataFrame, block: QueryBlock, options: Search, allowed: DataFrame | None
) -> DataFrame:
    options = replace(options, after={**(options.after or {}), **block.cursors})
    cell = [] if block.probes is None else ["cell"]
    rows = _candidates(vectors, block, options, allowed).select(*HIT_COLUMNS, *cell, "embedding")
    query_type = to_arrow_type(queries.schema["query_id"].dataType)
    by = f"{options.group_by}_id"
    if by == "video_id":
        rows = rows.filter(F.col(by).isNotNull())
    single = by == "clip_id" and options.modalities is not None and len(options.modalities) == 1
    hits = rows.mapInArrow(_top_rows(block, options, query_type, by, single), _hit_schema(vectors, queries))
    if not single:  # rows of one clip or video may lie in several tasks
        order = [F.desc("score"), "clip_id", "modality", "start_sec", "end_sec"]
        window = Window.partitionBy("query_id", by).orderBy(*order)
        hits = hits.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    ranked = _rank(hits, by, options, block)
    if by == "video_id":
        ranked = _with_hits(ranked, rows, block, options, query_type)
    return ranked.withColumn("confidence", confidence(F.col("score"), options.thresholds))


def _block_by_block(queries: DataFrame, find: Callable[[QueryBlock], DataFrame]) -> DataFrame:
    """What `find` gives for all blocks of queries. One block stays a plan; of several each one's result is written to the
    shared folder before the next but one is collected, so the driver never holds more than two."""
    blocks = query_blocks(queries)
    first = next(blocks, None)
    if first is None:
        raise ValueError("no queries")
    found, second = find(first), next(blocks, None)
    if second is None:
        return found
    folder = run_dir(queries.sparkSession, "search")
    found.write.parquet(folder)
    while second is not None:
        find(second).write.mode("append").parquet(folder)
        second = next(blocks, None)
    return queries.sparkSession.read.schema(found.schema).parquet(folder)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    options: Search = Search(),
    allowed: DataFrame | None = None,
    after: DataFrame | None = None,
) -> DataFrame:
    """Ranked hits per query: exact cosine similarity over the whole vector table.

    `vectors` has (clip_id, video_id, modality, start_sec, end_sec, embedding), `queries` has (query_id, embedding). `allowed`
    limits the search to some videos. With group_by="video" a hit is a video with its best clip and the number of its
    vectors that pass the threshold; vectors without a video take no part. That takes two scans: the first sends `limit` videos per
    task and query into the shuffle, the second counts for the winners. `after` goes on behind the rows of `next_cursor`.
    """
    if after is not None:
        queries = queries.select("query_id", "embedding").join(after.toDF("query_id", *CURSOR), "query_id", "left")
    return _block_by_block(queries, lambda block: _search_block(vectors, queries, block, options, allowed))


def next_cursor(hits: DataFrame, by: str = "clip_id") -> DataFrame:
    """Per query the (score, id, rank) to continue after; no more rows than queries."""
    last = F.max(F.struct("rank", "score", by)).alias("last")
    return hits.groupBy("query_id").agg(last).select("query_id", "last.score", f"last.{by}", "last.rank")


def _passing_rows(block: QueryBlock, options: Search, query_type: pa.DataType) -> Callable:
    """Per task and query the number of rows that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(block.ids), np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            batch, matrix = batch_matrix(batch)
            for part, queries in _query_chunks(block, len(matrix)):
                scores = batch_scores(matrix, queries)
                for column in np.flatnonzero((scores >= options.floor).any(axis=0)):
                    q = part.start + column
                    total[q] += _passing(batch, scores[:, column], q, block, options.floor, None).size
        found = np.flatnonzero(total)
        ids = pa.array([block.ids[q] for q in found], query_type)
        yield pa.RecordBatch.from_arrays([ids, pa.array(total[found])], names=["query_id", "total"])

    return run


def count_passing(
    vectors: DataFrame, queries: DataFrame, options: Search = Search(), allowed: DataFrame | None = None
) -> DataFrame:
    """Per query the number of all vectors that pass the threshold, whatever the limit; queries without any are left out."""
    kind = queries.schema["query_id"].dataType
    schema = T.StructType([T.StructField("query_id", kind), T.StructField("total", T.LongType())])

    def count(block: QueryBlock) -> DataFrame:
        rows = _candidates(vectors, block, options, allowed).select(*HIT_COLUMNS, "embedding")
        parts = rows.mapInArrow(_passing_rows(block, options, to_arrow_type(kind)), schema)
        return parts.groupBy("query_id").agg(F.sum("total").alias("total"))

    return _block_by_block(queries, count)


def hit_counts(hits: DataFrame) -> DataFrame:
    """Number of hits per query."""
    return hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("total"))


MAX_CELL_BITS = 16


def hyperplanes(dim: int, bits: int, seed: int = 7) -> np.ndarray:
    """Normal vectors of the hyperplanes that cut the cells, one per column."""
    if not 1 <= bits <= MAX_CELL_BITS:
        raise ValueError(f"bits must be in 1..{MAX_CELL_BITS}")
    return np.random.default_rng(seed).standard_normal((dim, bits))


def assign_cells(vectors: DataFrame, dim: int, bits: int = 6, seed: int = 7) -> DataFrame:
    """Add `cell`, the side of each of `bits` random hyperplanes that a vector is on.

    Written with `partitionBy("cell")`, a search reads only the folders of the cells it looks into.
    """
    planes = hyperplanes(dim, bits, seed)
    weights = 1 << np.arange(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch, matrix = batch_matrix(batch)
                cells = ((matrix @ planes > 0) @ weights).astype(np.int32)
                yield batch.append_column("cell", pa.array(cells))

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType())])
    return usable_vectors(vectors, dim).mapInArrow(run, schema)


def _probe_cells(block: QueryBlock, bits: int, seed: int, probes: int) -> QueryBlock:
    """Per query the `probes` cells that are cheapest to reach from its own."""
    margins = block.matrix @ hyperplanes(block.dim, bits, seed)
    cells = np.arange(1 << bits)
    sides = (cells[:, None] >> np.arange(bits)) & 1
    chosen = []
    for margin in margins:
        cost = ((sides != (margin > 0)) * np.abs(margin)).sum(axis=1)
        chosen.append(np.sort(np.argsort(cost, kind="stable")[:probes]))
    return replace(block, probes=chosen)


def search_approx(
    celled: DataFrame,
    queries: DataFrame,
    options: Search = Search(),
    allowed: DataFrame | None = None,
    bits: int = 6,
    seed: int = 7,
    probes: int = 16,
) -> DataFrame:
    """Like `search`, over vectors with cells, looking only into the `probes` cells nearest to each query.

    Scores are exact; hits in other cells are missed. probes = 2 ** bits gives the exact answer.
    """

    def near(block: QueryBlock) -> DataFrame:
        block = _probe_cells(block, bits, seed, probes)
        wanted = sorted({int(c) for cells in block.probes for c in cells})
        rows = celled if len(wanted) == 1 << bits else celled.filter(F.col("cell").isin(wanted))
        return _search_block(rows, queries, block, options, allowed)

    return _block_by_block(queries, near)
