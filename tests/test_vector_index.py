"""The trained index: recall against the exact search, exactness with everything probed, what is read."""

import numpy as np
import pytest

from mediacat.operators import search as os_
from mediacat.operators import vector_index as vi
from mediacat.operators.search import Search
from mediacat.plans import views

ALL = Search(limit=10, threshold=None, modalities=None)


def pairs(hits):
    return {(r.query_id, r.clip_id, r.score, r["rank"]) for r in hits.collect()}


@pytest.fixture(scope="module")
def stored(spark):
    from mediacat.session import run_dir

    vectors = views.vectors(spark, "/root/testdata/sf0.1")
    folder = run_dir(spark, "index-test")
    vi.write_index(vectors, vi.fit(vectors, 64, cells=16, parts=32, words=32), folder)
    return vectors, *vi.read_index(spark, folder)


def test_recall_is_nine_tenths(spark, stored):
    """Forty queries over 2,000 vectors that are close to random: three quarters of the codes, one vector in twenty."""
    vectors, rows, index = stored
    queries = vectors.where("clip_id % 50 = 7").selectExpr("clip_id AS query_id", "embedding")
    found = vi.search_index(rows, index, queries, ALL, probes=12, rerank=100)
    shares = [r["recall"] for r in vi.recall(found, os_.search(vectors, queries, ALL)).collect()]
    assert len(shares) == 40 and np.mean(shares) >= 0.9
    block = vi.probe(index, next(os_.query_blocks(queries)), 12)
    sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}
    read = np.mean([sum(sizes.get(int(c), 0) for c in cells) for cells in block.probes]) / vectors.count()
    assert 0.6 < read < 0.85 and 100 / vectors.count() <= 0.05


def test_scores_are_exact_and_everything_probed_is_exact(spark, stored):
    vectors, rows, index = stored
    queries = views.label_queries(spark, "/root/testdata/sf0.1")
    whole = pairs(os_.search(vectors, queries, ALL))
    assert pairs(vi.search_index(rows, index, queries, ALL, probes=16, rerank=5000)) == whole
    true = {(q, c): s for q, c, s, _ in pairs(os_.search(vectors, queries, Search(limit=2000, threshold=None, modalities=None)))}
    assert all(true[q, c] == s for q, c, s, _ in pairs(vi.search_index(rows, index, queries, ALL, probes=2, rerank=10)))


def test_options_and_pages(spark, stored):
    vectors, rows, index = stored
    queries = views.label_queries(spark, "/root/testdata/sf0.1")
    for options in (Search(limit=5, threshold="medium"), Search(limit=7, threshold=None, modalities=["logo"])):
        assert pairs(vi.search_index(rows, index, queries, options, probes=16, rerank=5000)) == pairs(os_.search(vectors, queries, options))
    allowed = vectors.where("clip_id % 3 = 0").select("video_id").distinct().limit(4)
    assert pairs(vi.search_index(rows, index, queries, ALL, allowed, probes=16, rerank=5000)) == pairs(os_.search(vectors, queries, ALL, allowed))
    first = [(q, (s, c, 10)) for q, c, s, rank in pairs(os_.search(vectors, queries, ALL)) if rank == 10]
    paged = Search(limit=10, threshold=None, modalities=None, after=dict(first))
    assert pairs(vi.search_index(rows, index, queries, paged, probes=16, rerank=5000)) == pairs(os_.search(vectors, queries, paged))
    for wrong in ({"options": Search(group_by="video")}, {"options": ALL, "rerank": 9}):
        with pytest.raises(ValueError):
            vi.search_index(rows, index, queries, **wrong)


def test_the_first_scan_reads_codes_only(spark, stored, capsys):
    _, rows, index = stored
    vi.search_index(rows, index, views.label_queries(spark, "/root/testdata/sf0.1"), ALL, probes=3).explain("formatted")
    schemas = [line for line in capsys.readouterr().out.splitlines() if line.startswith("ReadSchema") and "clip_id" in line]
    assert any("code" in s and "embedding" not in s for s in schemas) and any("embedding" in s and "code" not in s for s in schemas)


def test_nearest_and_codes_equal_brute_force():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 12))
    found = vi.centres(rows, 7, 4)
    want = np.array([min(range(7), key=lambda c: ((r - found[c]) ** 2).sum()) for r in rows])
    assert np.array_equal(vi.nearest(rows, found), want)
    index = vi.VectorIndex(found, tuple(rng.normal(size=(5, w)) for w in (5, 4, 3)))
    cell, codes = vi.encode(index, rows)
    for r, c, code in zip(rows, cell, codes):
        rest = np.split(r - found[c], [5, 9])
        assert [int(np.argmin(((w - p) ** 2).sum(axis=1))) for w, p in zip(index.words, rest)] == code.tolist()


def test_small_and_odd_tables(spark):
    rows = [
        (1, "a", "visual", 0.0, 1.0, [1.0, 0.0]), (1, "a", "visual", 0.0, 1.0, [1.0, 0.0]), (2, "a", None, 0.0, 1.0, [0.0, 1.0]), (3, "a", "logo", 0.0, 1.0, None),
        (4, "a", "logo", 0.0, 1.0, [0.0, 0.0]), (5, None, "logo", 0.0, 1.0, [None, 1.0]), (6, "a", "logo", 0.0, 1.0, [1.0]), (7, None, "logo", 0.0, 1.0, [0.5, 0.5]),
    ]
    vectors = spark.createDataFrame(rows, "clip_id long, video_id string, modality string, start_sec double, end_sec double, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.2])], "query_id string, embedding array<double>")
    index = vi.fit(vectors, 2, cells=9, parts=2, words=9)
    assert len(index.centroids) == 4  # no more than the sample
    hits = vi.search_index(vi.index_rows(vectors, index), index, queries, ALL, probes=9)
    assert pairs(hits) == pairs(os_.search(vectors, queries, ALL)) and {r.clip_id for r in hits.collect()} == {1, 2, 7}
    with pytest.raises(ValueError):
        vi.fit(vectors.limit(0), 2)
    with pytest.raises(ValueError):
        vi.fit(vectors, 2, words=257)
    assert len(vi.sample(vectors, 2, 2)) == 2
