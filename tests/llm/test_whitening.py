"""Whitening against NumPy and whole numbers."""

import math

import numpy as np
import pytest

from mediacat.llm import queries, whitening


def brute(vectors):
    """n, sums, covariance and exact squares by plain loops over whole numbers."""
    n = len(vectors)
    sums = [sum(c) for c in zip(*vectors)]
    centred = [[n * a - s for a, s in zip(v, sums)] for v in vectors]
    return n, sums, centred


def check(rows, vectors, components=8):
    """rows: results; vectors: id -> whole numbers of the vectors that take part."""
    n, sums, centred = brute(list(vectors.values()))
    x = np.array([[c / n for c in row] for row in centred])
    covariance = x.T @ x / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(got) == len(rows) == n * len(values)
    for number, (vec_id, c) in enumerate(zip(vectors, centred)):
        assert {got[vec_id, k + 1]["deviation"] for k in range(len(values))} == {sum(a * a for a in c)}
    for k in range(len(values)):
        mine = np.array([got[i, k + 1]["whitened"] for i in vectors])
        want = x @ basis[:, k] / math.sqrt(values[k])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
        assert all(math.isclose(got[i, k + 1]["explained"], values[k] / np.trace(covariance), rel_tol=1e-9) for i in vectors)
    assert {r["n"] for r in rows} == {n} and {r["identity_error"] for r in rows}.pop() < 1e-9


def test_query_equals_numpy(spark):
    data = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    vectors = {r["vec_id"]: [math.floor(1024 * float(c)) + 100_000 for c in r["embedding"]] for r in data}
    rows = queries.op12_whitening(spark, "/root/testdata/sf0.01").collect()
    assert dict(zip(("n", "rows"), (rows[0]["n"], len(rows)))) == {"n": len(data), "rows": 8 * len(data)}
    check(rows, vectors)


def test_squares_are_exact():
    rng = np.random.default_rng(2)
    for bound in (10, 2**21, 2**40, 2**62):
        values = rng.integers(-bound, bound, (500, 7))
        values[0], values[1] = bound - 1, 1 - bound
        want = [sum(int(v) ** 2 for v in column) for column in values.T]
        assert whitening.squares(values).tolist() == want == whitening.squares(values.astype(object)).tolist()


def test_polarisation_gives_products():
    rng = np.random.default_rng(3)
    c = rng.integers(-(2**50), 2**50, (40, 5))
    totals = np.concatenate([whitening.squares(c), *(whitening.squares(c[:, j, None] + c[:, j + 1 :]) for j in range(4))])
    want = [[sum(int(a) * int(b) for a, b in zip(c[:, j], c[:, k])) for k in range(5)] for j in range(5)]
    assert whitening.polarised(totals.tolist(), 5) == want


def test_large_values_take_the_exact_path(spark):
    rows = [(i, [2**60 - i * i * 10**15, i * 10**14, 7**i]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    got = whitening.whiten(df).collect()
    _, _, centred = brute([v for _, v in rows])
    for (vec_id, _), c in zip(rows, centred):
        deviation = sum(a * a for a in c)
        assert {r["deviation"] for r in got if r["vec_id"] == vec_id} == {deviation if deviation < 10**38 else None}
    assert got[0]["identity_error"] < 1e-4 and {r["component"] for r in got} == {1, 2, 3}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0, 2.0]), (2, [0.25, -1.0, 0.5]), (2, [0.25, -1.0, 0.5]), (None, [1.0, 0.0, 0.75]), (3, None), (4, [0.5, None, 1.0]),
        (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]), (7, []), (8, [1.0]), (9, [-0.0001, 3.0, 1e-9]), (10, [1.0, 2.0, 3.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as x", "1 as n", "2.5 as whitened", "0 as component")
    got = whitening.whiten(whitening.whole_vectors(df)).collect()
    assert len(got) == 3 * 6 and {r["n"] for r in got} == {6} and sum(r["vec_id"] is None for r in got) == 3
    assert got[0]["identity_error"] < 1e-9
    distinct = {(r["vec_id"], r["component"], r["whitened"]) for r in got if r["vec_id"] == 2}
    assert len(distinct) == 3


def test_without_variance(spark):
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<double>")
    for df in (same, same.limit(1)):
        got = whitening.whiten(whitening.whole_vectors(df)).collect()
        assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got} == {(0, None, 0.0, None)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(whitening.whole_vectors(line)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in got) and got[0]["identity_error"] < 1e-9
    assert whitening.whiten(whitening.whole_vectors(same.limit(0))).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 5.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(whitening.whole_vectors(huge)).count() == 4
