"""Batch model jobs."""

import pytest

from mediacat.operators.embed import embed, generate
from mediacat.plans.model_queries import count_words


def rows(spark, n=50):
    return spark.createDataFrame([(f"v{i}", i) for i in range(n)], "video_id string, x int").repartition(4)


def test_failing_rows_are_isolated(spark):
    def model(batch):
        if (batch["x"] % 10 == 3).any():
            raise ValueError(f"cannot embed {batch['x'].iloc[0]}" if len(batch) == 1 else "batch")
        return [[float(x), 1.0] if x % 10 != 4 else None for x in batch["x"]]

    got = {r.video_id: (r.embedding, r.error) for r in embed(rows(spark), model, batch_rows=7, tasks=3).collect()}
    assert len(got) == 50
    assert got["v13"] == (None, "cannot embed 13") and got["v14"] == (None, None) and got["v15"] == ([15.0, 1.0], None)
    assert sum(e is not None for _, e in got.values()) == 5


def test_a_vector_that_is_no_vector_is_its_rows_error(spark):
    odd = {2: [None], 3: ["x"], 4: 5, 5: [[1.0], [2.0]]}
    got = {r.video_id: (r.embedding, r.error) for r in embed(rows(spark, 8), lambda b: [odd.get(x, [x, 1]) for x in b["x"]], batch_rows=4).collect()}
    assert all(got[f"v{i}"][0] is None and got[f"v{i}"][1] for i in odd)
    assert got["v1"] == ([1.0, 1.0], None) and got["v7"] == ([7.0, 1.0], None)


def test_wrong_number_of_results_is_an_error_of_the_batch(spark):
    got = embed(rows(spark, 4), lambda batch: [[1.0]] * (len(batch) + 1)).collect()
    assert {r.error for r in got} == {"2 results for 1 rows"}


def test_result_of_the_wrong_kind_fails_the_row_or_the_task(spark):
    got = generate(rows(spark, 3).withColumnRenamed("x", "y"), lambda b, k, p: [f"{k}/{p}/{y}" for y in b["y"]], "highlight", "P")
    assert sorted(r.text for r in got.collect()) == ["highlight/P/0", "highlight/P/1", "highlight/P/2"]
    with pytest.raises(ValueError):
        generate(rows(spark), count_words, "poem")
