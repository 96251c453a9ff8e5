"""Queries over vectors and search responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.functions.hits import parse_hits as hits_of
from mediacat.operators import search as os_
from mediacat.operators import vector_index
from mediacat.operators.paging import clamp_limit
from mediacat.operators.search import Search
from mediacat.plans import views
from mediacat.plans.registry import query
from mediacat.plans.views import with_views
from mediacat.schemas import MODALITIES, SEARCH_LIMIT, SEARCH_LIMIT_MAX
from mediacat.session import run_dir

ALL = Search(limit=10, threshold=None, modalities=None)


def _scored(queries: str, where: str = "true") -> str:
    return f"""scored AS (SELECT query_id, clip_id, video_id, modality, start_sec, end_sec,
        round(list_cosine_similarity(v.embedding, q.embedding), 6) + 0.0 AS score
        FROM vectors v CROSS JOIN {queries} q WHERE {where})"""


_CONFIDENCE = """CASE WHEN score >= 0.30 THEN 'high' WHEN score >= 0.15 THEN 'medium' WHEN score >= 0.0 THEN 'low'
    ELSE 'none' END AS confidence"""


def _top(limit: int, where: str = "true", skip: int = 0) -> str:
    return f"""SELECT query_id, clip_id, video_id, modality, start_sec, end_sec, score, rank::INTEGER AS rank,
        {_CONFIDENCE} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, clip_id) AS rank
        FROM scored WHERE {where}) WHERE rank > {skip} AND rank <= {skip + limit}"""


@query("V1", "J7", sql=with_views(_top(10), "vectors", "first_query", ctes=_scored("first_query")))
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return os_.search(views.vectors(spark, sf_dir), views.first_query(spark, sf_dir), ALL)


@query("V1", "J7", sql=with_views(_top(10), "vectors", "label_queries", ctes=_scored("label_queries")))
def search_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label. A request for 99 is out of the served range, so it gets the default limit."""
    queries = views.label_queries(spark, sf_dir)
    return os_.search(views.vectors(spark, sf_dir), queries, Search(limit=clamp_limit(99, SEARCH_LIMIT, SEARCH_LIMIT_MAX), threshold=None, modalities=None))


@query(
    "V3",
    sql=with_views(_top(50, "score >= 0.30"), "vectors", "label_queries", ctes=_scored("label_queries")),
)
def search_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = Search(limit=50, threshold="high", modalities=None)
    return os_.search(views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir), options)


@query(
    "V2",
    sql=with_views(
        f"""SELECT query_id, video_id, clip_id, modality, start_sec, end_sec, score, hits, rank::INTEGER AS rank,
        {_CONFIDENCE} FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, video_id) AS rank
            FROM (SELECT *, count(*) OVER (PARTITION BY query_id, video_id) AS hits FROM scored WHERE score >= 0.0
                QUALIFY row_number() OVER (PARTITION BY query_id, video_id ORDER BY score DESC, clip_id) = 1))
        WHERE rank <= 5""",
        "vectors",
        "label_queries",
        ctes=_scored("label_queries"),
    ),
)
def search_by_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = Search(limit=5, group_by="video", threshold="low", modalities=None)
    return os_.search(views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir), options)


_ALLOWED = "video_id IN (SELECT video_id FROM catalog WHERE status = 'ready')"


@query("V4", sql=with_views(_top(10), "catalog", "vectors", "label_queries", ctes=_scored("label_queries", _ALLOWED)))
def search_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only videos that the catalogue has as ready."""
    ready = views.catalog(spark, sf_dir).filter(F.col("status") == "ready")
    return os_.search(views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir), ALL, ready)


@query(
    "V5",
    sql=with_views(
        _top(10, "score >= 0.15"),
        "vectors",
        "label_queries",
        ctes=_scored("label_queries", "modality IN ('visual', 'conversation')"),
    ),
)
def search_modalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default options: visual and conversation, medium confidence, ten hits."""
    return os_.search(views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir))


_CLIPS = """rows AS (SELECT vec_id // 4 AS clip_id, CASE vec_id % 4 WHEN 0 THEN 'visual' WHEN 1 THEN 'conversation'
    WHEN 2 THEN 'text_in_video' ELSE 'logo' END AS modality, embedding::DOUBLE[] AS embedding FROM embeddings),
    scored AS (SELECT query_id, clip_id, 'v' || clip_id AS video_id, modality, clip_id * 5.0::DOUBLE AS start_sec,
        clip_id * 5.0::DOUBLE + 5 AS end_sec,
        round(list_cosine_similarity(r.embedding, q.embedding), 6) + 0.0 AS score FROM rows r CROSS JOIN label_queries q
        QUALIFY row_number() OVER (PARTITION BY query_id, clip_id ORDER BY score DESC, modality) = 1)"""


@query("V5", sql=with_views(_top(10), "label_queries", ctes=_CLIPS))
def search_best_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips with four modalities each: a clip scores as its best modality."""
    clip = F.floor(F.col("clip_id") / 4)
    vectors = views.vectors(spark, sf_dir).withColumns(
        {
            "clip_id": clip,
            "video_id": F.concat(F.lit("v"), clip.cast("string")),
            "start_sec": clip * F.lit(5.0),
            "end_sec": clip * F.lit(5.0) + 5,
        }
    )
    options = Search(threshold=None, modalities=MODALITIES)
    return os_.search(vectors, views.label_queries(spark, sf_dir), options)


@query("V6", sql=with_views(_top(10, skip=10), "vectors", "label_queries", ctes=_scored("label_queries")))
def search_next_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second ten hits, continued after the last hit of the first ten."""
    vectors, queries = views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir)
    return os_.search(vectors, queries, ALL, after=os_.next_cursor(os_.search(vectors, queries, ALL)))


_IN_INDEX = "v.clip_id % 4 = 1"


@query("V1", "S7", "K8", sql=with_views(_top(10), "vectors", "label_queries", ctes=_scored("label_queries", _IN_INDEX)))
def search_in_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search in one index of a vector table that is stored by index."""
    folder = run_dir(spark, "indexes")
    index = F.concat(F.lit("idx_"), (F.col("clip_id") % 4).cast("string"))
    views.vectors(spark, sf_dir).withColumn("index_id", index).write.partitionBy("index_id").parquet(folder)
    options = Search(threshold=None, modalities=None, index_id="idx_1")
    return os_.search(spark.read.parquet(folder), views.label_queries(spark, sf_dir), options)


@query(
    "A7",
    sql=with_views(
        "SELECT query_id, count(*) AS total FROM scored WHERE score >= 0.15 GROUP BY query_id",
        "vectors",
        "label_queries",
        ctes=_scored("label_queries"),
    ),
)
def search_hit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return os_.count_passing(views.vectors(spark, sf_dir), views.label_queries(spark, sf_dir), Search(modalities=None))


# The index of the next queries: small enough to be fitted again in SQL.
CELLS, PARTS, WORDS, ROUNDS, PROBES, RERANK, DIM = 16, 32, 32, 3, 12, 100, 64


def _lloyd(name: str, rows: str, count: int, rounds: int) -> str:
    """Rounds of nearest centre and mean. `rows` has (part, n, v): part number, place in the sample, vector."""
    steps = [f"{name}0 AS MATERIALIZED (SELECT part, n AS c, v AS centre FROM {rows} WHERE n < {count})"]
    for i in range(rounds):
        near, means, old = f"{name}_near{i}", f"{name}_mean{i}", f"{name}{i}"
        steps.append(_nearest(near, rows, old))
        steps.append(f"""{means} AS (SELECT part, c, list(mean ORDER BY d) AS centre FROM (
            SELECT part, c, d, avg(v[d]) AS mean FROM {near} JOIN {rows} USING (part, n), range(1, {DIM + 1}) r(d)
            WHERE d <= len(v) GROUP BY ALL) GROUP BY ALL)""")
        steps.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT o.part, o.c, coalesce(m.centre, o.centre) AS centre
            FROM {old} o LEFT JOIN {means} m ON m.part = o.part AND m.c = o.c)""")
    return ", ".join(steps)


def _nearest(name: str, rows: str, centres: str) -> str:
    """The number c of the nearest centre for each (part, n)."""
    return f"""{name} AS MATERIALIZED (SELECT part, n, arg_max(c, (closeness, -c)) AS c FROM (
        SELECT part, n, c, round(list_inner_product(v, centre) - list_inner_product(centre, centre) / 2, 9) AS closeness
        FROM {rows} JOIN {centres} USING (part)) GROUP BY ALL)"""


_WIDTH = DIM // PARTS
_INDEX_SQL = f"""units AS MATERIALIZED (SELECT *, 0 AS part, row_number() OVER (ORDER BY md5(clip_id || ':' || modality)) - 1 AS n,
        list_transform(embedding, lambda x: x / sqrt(list_inner_product(embedding, embedding))) AS v FROM vectors),
    {_lloyd("coarse", "units", CELLS, ROUNDS)}, {_nearest("cell_of", "units", f"coarse{ROUNDS}")},
    residuals AS (SELECT u.n, list_transform(list_zip(u.v, k.centre), lambda p: p[1] - p[2]) AS v
        FROM units u JOIN cell_of o ON o.n = u.n JOIN coarse{ROUNDS} k ON k.c = o.c),
    pieces AS MATERIALIZED (SELECT part, n, v[part * {_WIDTH} + 1 : (part + 1) * {_WIDTH}] AS v FROM residuals, range({PARTS}) r(part)),
    {_lloyd("words", "pieces", WORDS, ROUNDS)}, {_nearest("code_of", "pieces", f"words{ROUNDS}")},
    asked AS (SELECT query_id, list_transform(embedding, lambda x: x / sqrt(list_inner_product(embedding, embedding))) AS v FROM label_queries),
    probed AS (SELECT query_id, c, list_inner_product(v, centre) AS near FROM asked, coarse{ROUNDS}
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY
            round(list_inner_product(v, centre) - list_inner_product(centre, centre) / 2, 9) DESC, c) <= {PROBES}),
    offers AS MATERIALIZED (SELECT query_id, part, c, list_inner_product(v[part * {_WIDTH} + 1 : (part + 1) * {_WIDTH}], centre) AS offer
        FROM asked, words{ROUNDS}),
    estimated AS (SELECT p.query_id, o.n, round(any_value(p.near) + sum(f.offer), 6) AS estimate
        FROM probed p JOIN cell_of o ON o.c = p.c JOIN code_of d ON d.n = o.n
        JOIN offers f ON f.query_id = p.query_id AND f.part = d.part AND f.c = d.c GROUP BY ALL),
    survivors AS (SELECT query_id, clip_id FROM estimated JOIN units USING (n)
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY estimate DESC, clip_id, modality) <= {RERANK})"""
_SURVIVES = "EXISTS (SELECT 1 FROM survivors s WHERE s.query_id = q.query_id AND s.clip_id = v.clip_id)"


def _stored_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, vector_index.VectorIndex]:
    folder = run_dir(spark, "index")
    vectors = views.vectors(spark, sf_dir)
    vector_index.write_index(vectors, vector_index.fit(vectors, DIM, CELLS, PARTS, WORDS, rounds=ROUNDS), folder)
    return vector_index.read_index(spark, folder)


@query(
    "V9",
    sql=with_views(_top(10), "vectors", "label_queries", ctes=f'{_INDEX_SQL}, {_scored("label_queries", _SURVIVES)}'),
)
def search_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search over a trained, stored index: codes of three quarters of the cells are read and 100 vectors a query."""
    rows, index = _stored_index(spark, sf_dir)
    return vector_index.search_index(rows, index, views.label_queries(spark, sf_dir), ALL, probes=PROBES, rerank=RERANK)


_FOUND = f"""{_INDEX_SQL}, {_scored("label_queries")}, best AS (SELECT * FROM scored
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, clip_id) <= 10)"""


@query(
    "V9",
    sql=with_views(
        "SELECT query_id, count(s.clip_id) / count(*) AS recall FROM best b LEFT JOIN survivors s USING (query_id, clip_id) GROUP BY query_id",
        "vectors", "label_queries", ctes=_FOUND,
    ),
)
def search_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the ten nearest of each query, the share that the index finds."""
    rows, index = _stored_index(spark, sf_dir)
    queries = views.label_queries(spark, sf_dir)
    found = vector_index.search_index(rows, index, queries, ALL, probes=PROBES, rerank=RERANK)
    return vector_index.recall(found, os_.search(views.vectors(spark, sf_dir), queries, ALL))


@query("V9", sql=with_views(_top(10), "vectors", "label_queries", ctes=_scored("label_queries")))
def search_all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every cell probed, which is the exact answer."""
    celled = os_.assign_cells(views.vectors(spark, sf_dir), dim=64, bits=4)
    return os_.search_approx(celled, views.label_queries(spark, sf_dir), ALL, bits=4, probes=16)


@query(
    "P19",
    sql="""SELECT event_id, 0::INTEGER AS position, 'v' || user_id AS video_id, user_id + 0.5::DOUBLE AS score,
        1.0::DOUBLE AS start, 2.5::DOUBLE AS "end", 'high' AS confidence, 't' || event_id AS thumbnail_url FROM events
        WHERE event_type = 'click'
        UNION ALL SELECT event_id, 2, '', 0, 0, 0, '', '' FROM events WHERE event_type = 'click'""",
)
def parse_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of several shapes: two hits with a stray number, no array, no data, no JSON, an empty array."""
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    two = F.concat(
        F.lit('{"data":[{"video_id":"v'), user, F.lit('","score":'), user,
        F.lit('.5,"start":1,"end":2.5,"confidence":"high","thumbnail_url":"t'), event,
        F.lit('"},7,{"video_id":5,"score":"0.9","start":null,"end":true}]}'),
    )
    kind = F.col("event_type")
    response = F.when(kind == "click", two).when(kind == "view", '{"data":"none"}').when(kind == "error", "oops")
    response = response.when(kind == "signup", '{"data":[]}').otherwise('{"page":1}')
    rows = views.table(spark, sf_dir, "events").select("event_id", response.alias("response"))
    return hits_of(rows, "response")
