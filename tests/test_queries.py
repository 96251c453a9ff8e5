"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from mediacat.plans.registry import registered
from tools.check_oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registered()

# Inventory entries that a query must exercise.
INVENTORY = (
    [f"S{i}" for i in range(1, 10)]
    + [f"K{i}" for i in range(1, 13)]
    + [f"P{i}" for i in range(1, 20)]
    + [f"D{i}" for i in range(1, 11)]
    + [f"J{i}" for i in range(1, 8)]
    + [f"A{i}" for i in range(1, 10)]
    + [f"Q{i}" for i in range(1, 8)]
    + [f"V{i}" for i in range(1, 11)]
    + [f"T{i}" for i in range(1, 7)]
    + ["R1"]
)


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name].run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan  # no query forms all pairs
    got = rows_of(df.columns, df.collect())
    if QUERIES[name].sql is None:
        assert got
        return
    result = con.execute(QUERIES[name].sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert got == rows_of(names, result.fetchall())


def test_inventory_is_covered():
    seen = {i for q in QUERIES.values() for i in q.ids}
    assert [i for i in INVENTORY if i not in seen] == []
