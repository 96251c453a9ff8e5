"""Search against a brute-force ranking."""

import numpy as np
import pyarrow as pa
import pytest

from mediacat.operators import search as os_
from mediacat.operators.search import Search
from mediacat.plans import views

DIM = 8
DDL = "clip_id long, video_id string, modality string, start_sec double, end_sec double, embedding array<float>"
MODES = ("visual", "conversation", "text_in_video", "logo")


def make(rows=400, seed=1, repeats=True):
    """Vectors with many exact repeats (ties), and one video that holds a third of them."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((rows // 4 if repeats else rows, DIM)).astype(np.float32)
    out = []
    for i in range(rows):
        video = "hot" if i % 3 == 0 else f"v{i % 17}"
        vector = base[rng.integers(len(base))] if repeats else base[i]
        out.append((i // 2, video, MODES[i % 4], float(i), float(i + 1), [float(x) for x in vector]))
    return out


def brute(rows, queries, limit, floor=-2.0, modes=None, videos=None, after=None):
    hits = {}
    for qid, q in queries:
        q = np.array(q) / np.linalg.norm(q)
        best = {}
        for clip, video, mode, _, _, vector in rows:
            if (modes and mode not in modes) or (videos is not None and video not in videos):
                continue
            score = round(float(np.dot(q, vector) / np.linalg.norm(vector)), 6)
            if score < floor:
                continue
            if after and not (score < after[qid][0] or (score == after[qid][0] and clip > after[qid][1])):
                continue
            best[clip] = max(best.get(clip, -9), score)
        hits[qid] = sorted(((-s, c) for c, s in best.items()))[:limit]
    return {q: [(c, pytest.approx(-s, abs=2e-6)) for s, c in h] for q, h in hits.items()}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.clip_id, r.score))
    return out


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def queries():
    rng = np.random.default_rng(9)
    return [(f"q{i}", [float(x) for x in rng.standard_normal(DIM)]) for i in range(5)]


def frames(spark, rows, queries, parts=7):
    q = spark.createDataFrame(queries, "query_id string, embedding array<double>")
    return spark.createDataFrame(rows, DDL).repartition(parts), q


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("modes", [None, ("visual",), ("visual", "logo")])
def test_topk_equals_brute_force_whatever_the_partitions(spark, rows, queries, parts, modes):
    vectors, q = frames(spark, rows, queries, parts)
    got = found(os_.search(vectors, q, Search(limit=20, threshold=None, modalities=modes)))
    assert got == brute(rows, queries, 20, modes=modes)


def test_threshold_and_filter(spark, rows, queries):
    vectors, q = frames(spark, rows, queries)
    allowed = spark.createDataFrame([("hot",), ("v1",), ("v1",)], "video_id string")
    got = found(os_.search(vectors, q, Search(limit=50, threshold="high", modalities=None), allowed))
    expected = brute(rows, queries, 50, floor=0.3, videos={"hot", "v1"})
    assert got == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("modes", [None, ("visual",)])
def test_pages_follow_each_other(spark, rows, queries, modes):
    """Also where a clip has rows on both sides of a page's end."""
    vectors, q = frames(spark, rows, queries)
    pages, after, ranks = [], None, []
    for _ in range(3):
        hits = os_.search(vectors, q, Search(limit=15, threshold=None, modalities=modes, after=after))
        pages.append(found(hits))
        ranks += [r.rank for r in hits.filter("query_id = 'q0'").orderBy("rank").collect()]
        after = {r.query_id: (r.score, r.clip_id, r["rank"]) for r in os_.next_cursor(hits).collect()}
    whole = brute(rows, queries, 45, modes=modes)
    assert {k: pages[0][k] + pages[1][k] + pages[2][k] for k in whole} == whole
    assert ranks == list(range(1, 46))


def test_pages_of_videos(spark, rows, queries):
    vectors, q = frames(spark, rows, queries)

    def page(limit, after=None):
        options = Search(limit=limit, group_by="video", threshold=None, modalities=None, after=after)
        return os_.search(vectors, q, options)

    def ranked(df):
        return sorted((r.query_id, r["rank"], r.video_id, r.hits) for r in df.collect())

    first = page(6)
    after = {r.query_id: (r.score, r.video_id, r["rank"]) for r in os_.next_cursor(first, "video_id").collect()}
    assert sorted(ranked(first) + ranked(page(6, after))) == ranked(page(12))


def test_group_by_video_counts_all_hits(spark, rows, queries):
    vectors, q = frames(spark, rows, queries)
    got = os_.search(vectors, q, Search(limit=50, group_by="video", threshold="low", modalities=None)).collect()
    for qid, query in queries:
        unit = np.array(query) / np.linalg.norm(query)
        best, hits = {}, {}
        for clip, video, _, _, _, vector in rows:
            score = round(float(unit @ np.array(vector) / np.linalg.norm(vector)), 6)
            if score >= 0:
                hits[video] = hits.get(video, 0) + 1
                best[video] = min(best.get(video, (9, 0)), (-score, clip))
        mine = [r for r in got if r.query_id == qid]
        assert {r.video_id: r.hits for r in mine} == hits
        assert {r.video_id: r.clip_id for r in mine} == {v: b[1] for v, b in best.items()}


@pytest.mark.parametrize("limit, parts", [(1, 3), (3, 7), (4, 1)])
def test_few_videos_with_ties(spark, rows, queries, limit, parts):
    """Vectors repeat, so videos tie; the smaller id wins, wherever the rows lie."""
    vectors, q = frames(spark, rows, queries, parts)
    whole = os_.search(vectors, q, Search(limit=50, group_by="video", threshold=None, modalities=None)).collect()
    got = os_.search(vectors, q, Search(limit=limit, group_by="video", threshold=None, modalities=None)).collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in whole if r["rank"] <= limit)


@pytest.mark.parametrize("max_bytes", [8 * DIM * 3, 32 << 20])
def test_cursors_and_indexes(spark, rows, queries, monkeypatch, max_bytes):
    vectors, q = frames(spark, rows, queries)
    original = os_.query_blocks
    monkeypatch.setattr(os_, "query_blocks", lambda df: original(df, max_bytes))
    options = Search(limit=15, threshold=None, modalities=None)
    first = os_.search(vectors, q, options)
    second = os_.search(vectors, q, options, after=os_.next_cursor(first.filter("query_id <> 'q1'")))
    whole = brute(rows, queries, 30)
    expected = {k: v[:15] if k == "q1" else v[15:] for k, v in whole.items()}
    assert found(second) == expected
    in_two = vectors.selectExpr("*", "if(clip_id % 2 = 0, 'even', 'odd') AS index_id")
    even = found(os_.search(in_two, q, Search(limit=15, threshold=None, modalities=None, index_id="even")))
    assert even == brute([r for r in rows if r[0] % 2 == 0], queries, 15)
    with pytest.raises(ValueError):
        os_.search(vectors, spark.createDataFrame([(None, [1.0] * DIM), ("a", [1.0] * DIM)], q.schema))


def test_few_rows_of_a_search_by_video_are_shuffled(spark, rows, queries):
    vectors, q = frames(spark, rows, queries, 4)
    block = next(os_.query_blocks(q))
    options = Search(limit=2, group_by="video", threshold=None, modalities=None)
    run = os_._top_rows(block, options, pa.string(), "video_id", False)
    leaving = vectors.mapInArrow(run, os_._hit_schema(vectors, q)).count()
    assert leaving <= 4 * len(queries) * 2


def test_blocks_of_queries_give_the_same_hits(spark, rows, queries, monkeypatch):
    vectors, q = frames(spark, rows, queries)
    options = Search(threshold=None, modalities=None)
    whole = found(os_.search(vectors, q, options))
    blocks = list(os_.query_blocks(q, max_bytes=8 * DIM * 3))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b.ids) == [i for i, _ in queries]
    original = os_.query_blocks
    assert whole and len(list(os_.query_blocks(q))) == 1
    monkeypatch.setattr(os_, "query_blocks", lambda df: original(df, 8 * DIM * 3))
    monkeypatch.setattr(os_, "MAX_SCORE_BYTES", 1)
    assert found(os_.search(vectors, q, options)) == whole


def test_unusable_vectors_and_queries(spark, queries):
    rows = [
        (1, "a", "visual", 0.0, 1.0, [1.0] * DIM), (2, "a", "visual", 0.0, 1.0, [1.0]), (3, "a", "visual", 0.0, 1.0, None),
        (4, "a", "visual", 0.0, 1.0, [0.0] * DIM), (5, "a", "visual", 0.0, 1.0, [None] + [1.0] * (DIM - 1)), (6, "a", "visual", 0.0, 1.0, []),
    ]
    vectors, q = frames(spark, rows, queries, 2)
    hits = os_.search(vectors, q, Search(threshold=None))
    assert {r.clip_id for r in hits.collect()} == {1}
    assert {(r.clip_id, r.vector_dim) for r in os_.vector_rejects(vectors, DIM).collect()} == {(2, 1), (3, 0), (6, 0)}
    for bad in ([("q", [0.0] * DIM)], [("q", [1.0]), ("q", [1.0])], [("q", [1.0]), ("r", [1.0, 2.0])], []):
        with pytest.raises(ValueError):
            os_.search(vectors, spark.createDataFrame(bad, "query_id string, embedding array<double>"))


def test_options_are_checked():
    assert Search(limit=51).rows == 51 and Search().rows == 10
    for wrong in ({"group_by": "scene"}, {"threshold": "extreme"}, {"limit": 0}, {"limit": "50"}):
        with pytest.raises(ValueError):
            Search(**wrong)


def test_approximate_search_finds_most_and_all_with_all_cells(spark, queries):
    rows = make(2000, seed=4, repeats=False)
    vectors, q = frames(spark, rows, queries)
    options = Search(limit=10, threshold=None, modalities=None)
    exact = found(os_.search(vectors, q, options))
    celled = os_.assign_cells(vectors, DIM, bits=5)
    assert found(os_.search_approx(celled, q, options, bits=5, probes=32)) == exact
    near = found(os_.search_approx(celled, q, options, bits=5, probes=8))
    recall = np.mean([len({c for c, _ in near[k]} & {c for c, _ in exact[k]}) / 10 for k in exact])
    assert recall >= 0.7


def test_recall_on_the_given_vectors(spark):
    vectors = views.vectors(spark, "/root/testdata/sf0.01")
    queries = views.label_queries(spark, "/root/testdata/sf0.01")
    options = Search(limit=10, threshold=None, modalities=None)
    exact = found(os_.search(vectors, queries, options))
    celled = os_.assign_cells(vectors, 64, bits=6)
    near = found(os_.search_approx(celled, queries, options, bits=6, probes=16))
    recall = np.mean([len({c for c, _ in near[k]} & {c for c, _ in exact[k]}) / 10 for k in exact])
    assert recall > 0.3  # a quarter of the cells; the given vectors are close to random
