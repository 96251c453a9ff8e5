"""Batch model jobs: a user function turns batches of rows into vectors or texts; failing rows keep their error."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BatchFunction = Callable[[pd.DataFrame], Sequence[object]]
SPLIT_BYTES = 128 << 20  # size of an input split
GENERATE_KINDS = ("summary", "chapter", "highlight")


def _isolate(fn: BatchFunction, rows: pd.DataFrame, render: Callable[[object], object]) -> list[tuple[object, str | None]]:
    """(rendered result, error) per row. A batch that fails is halved and tried again, to find the rows at fault.

    A result that cannot be rendered is its row's own error.

    Only exceptions of the function count; a worker that dies fails the task, which Spark then repeats.
    """
    try:
        results = list(fn(rows))
        if len(results) != len(rows):
            raise ValueError(f"{len(results)} results for {len(rows)} rows")
        return [_rendered(r, render) for r in results]
    except MemoryError:
        raise
    except Exception as exc:  # noqa: BLE001 - the error is data here
        if len(rows) == 1:
            return [(None, str(exc) or type(exc).__name__)]
    half = len(rows) // 2
    return _isolate(fn, rows.iloc[:half], render) + _isolate(fn, rows.iloc[half:], render)


def _rendered(result: object, render: Callable[[object], object]) -> tuple[object, str | None]:
    try:
        return (None if result is None else render(result)), None
    except Exception as exc:  # noqa: BLE001 - the error is data here
        return None, str(exc) or type(exc).__name__


def _floats(vector: object) -> np.ndarray:
    """A flat vector of 32-bit floats; anything else raises."""
    if not isinstance(vector, np.ndarray) and any(x is None for x in vector):
        raise ValueError("a vector holds a null")
    values = np.asarray(vector, dtype=np.float32)
    if values.ndim != 1:
        raise ValueError(f"a vector has one dimension, not {values.ndim}")
    return values


def _tasks_wanted(df: DataFrame) -> int:
    """Number of tasks to spread the input over, 0 to leave it as it is read.

    A model is slow, so small input is dealt out to all cores. Large input has splits enough and is not moved.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    estimated = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return cores if estimated < cores * SPLIT_BYTES else 0


def _run(
    df: DataFrame,
    fn: BatchFunction,
    keys: Sequence[str],
    name: str,
    kind: T.DataType,
    render: Callable[[object], object],
    batch_rows: int,
    tasks: int | None,
) -> DataFrame:
    """Run `fn` over batches of rows; input too small to give every core a part is spread first."""
    fields = [df.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField(name, kind), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                rows = batch.iloc[start : start + batch_rows]
                results = _isolate(fn, rows, render)
                out = rows[list(keys)].reset_index(drop=True)
                out[name] = pd.Series([r for r, _ in results], dtype=object)
                out["error"] = pd.Series([e for _, e in results], dtype=object)
                yield out

    tasks = _tasks_wanted(df) if tasks is None else tasks
    return (df.repartition(tasks) if tasks else df).mapInPandas(run, schema)


def embed(
    df: DataFrame,
    fn: BatchFunction,
    keys: Sequence[str] = ("video_id",),
    batch_rows: int = 64,
    tasks: int | None = None,
) -> DataFrame:
    """(keys, embedding, error): `fn` maps a batch of rows to one vector per row. Its result must depend on the row only,
    since Spark may run a task twice. A null vector without an error means that the model had none."""
    floats = T.ArrayType(T.FloatType())
    return _run(df, fn, keys, "embedding", floats, _floats, batch_rows, tasks)


def generate(
    df: DataFrame,
    fn: Callable[[pd.DataFrame, str, str | None], Sequence[str]],
    kind: str = "summary",
    prompt: str | None = None,
    keys: Sequence[str] = ("video_id",),
    batch_rows: int = 64,
    tasks: int | None = None,
) -> DataFrame:
    """(keys, text, error): a summary, chapters or highlights per row, with an optional prompt."""
    if kind not in GENERATE_KINDS:
        raise ValueError(f"unknown kind: {kind}")
    return _run(df, lambda rows: fn(rows, kind, prompt), keys, "text", T.StringType(), str, batch_rows, tasks)
