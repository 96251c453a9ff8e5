"""Whitening of embeddings; covariances by polarisation.

The variance of a sum tells a covariance: var(a + b) = var(a) + var(b) + 2 cov(a, b). Tasks aggregate squared centred values of
every dimension and of every sum of two dimensions, exactly: with n rows and the sums S, n x - S is whole, and its squares
are added in limbs of 21 bits that cannot overflow a long. Their totals travel as two decimals each, one row per pair
of dimensions, so what the driver gathers is bounded by the square of the vector length. Half the difference of the
totals is a cross-covariance; the matrix goes to `eigh`, and a further pass projects the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import written

COMPONENTS = 8
SCALE = 1024
OFFSET = 100_000
ROWS = 2048
LIMB = 21
LARGEST = 2**61
PARTS = 10**18
"""Totals are split at this: each part of a sum over any number of tasks fits a decimal of 38 digits."""

OUT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whole_vectors(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x, the floor of `scale` times each component plus `offset`, as longs.

    Vectors that are null or empty, or hold null, NaN or an infinity, are left out. Beyond 2^61 either way a component counts as 2^61.
    """
    fine = F.expr("size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity'))")
    bound = F.lit(float(LARGEST - 2 * abs(offset) - 2**10))
    return vectors.where(F.col("embedding").isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(
            F.col("embedding").cast("array<double>"), lambda c: F.floor(F.least(F.greatest(c * float(scale), -bound), bound)) + F.lit(offset).cast("long")
        ).alias("x"),
    )


def _blocks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)


def squares(values: np.ndarray) -> np.ndarray:
    """The exact sum of squares of each column, as Python integers. At most `ROWS` rows of longs or of Python integers."""
    if values.dtype == object:
        return (values * values).sum(axis=0)
    mask = (1 << LIMB) - 1
    high, middle, low = values >> (2 * LIMB), (values >> LIMB) & mask, values & mask

    def total(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->j", a, b).astype(object)

    return (
        (total(high, high) << (4 * LIMB)) + (total(high, middle) << (3 * LIMB + 1))
        + ((2 * total(high, low) + total(middle, middle)) << (2 * LIMB)) + (total(middle, low) << (LIMB + 1)) + total(low, low)
    )


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S: longs where sums of two of them fit a long, else Python integers."""
    if n * max(abs(int(x.max())), abs(int(x.min()))) < 2**61:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _rows(totals: np.ndarray) -> pa.RecordBatch:
    numbers = [int(t) for t in totals]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(range(len(numbers)), pa.int64()),
            pa.array([Decimal(t // PARTS) for t in numbers], pa.decimal128(38, 0)), pa.array([Decimal(t % PARTS) for t in numbers], pa.decimal128(38, 0)),
        ],
        names=["place", "high", "low"],
    )


def _sums(size: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, object)
        for part, x in _blocks(batches, size):
            high, low = x >> 32, x & 0xFFFFFFFF
            total[1:] += (high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
            total[0] += len(x)
        if total[0]:
            yield _rows(total)

    return run


def _pair_squares(size: int, n: int, sums: list[int]) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, size):
            c = centred(x, n, sums)
            own = [squares(c), *(squares(c[:, j, None] + c[:, j + 1 :]) for j in range(size - 1))]
            found = np.concatenate(own)
            total = found if total is None else total + found
        if total is not None:
            yield _rows(total)

    return run


def _gather(df: DataFrame, length: int) -> list[int]:
    """The totals by place; one small row per place reaches the driver."""
    rows = df.groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    out = [0] * length
    for row in rows:
        out[row["place"]] = int(row["high"]) * PARTS + int(row["low"])
    return out


def polarised(totals: list[int], size: int) -> list[list[int]]:
    """Sums of products of centred values from sums of squares: of each dimension, then of each pair's sum."""
    out = [[0] * size for _ in range(size)]
    at = size
    for j in range(size):
        out[j][j] = totals[j]
        for k in range(j + 1, size):
            out[j][k] = out[k][j] = (totals[at] - totals[j] - totals[k]) // 2
            at += 1
    return out


def principal(products: list[list[int]], n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns), eigenvalues and shares of the trace, by falling eigenvalue.

    products: sums of products of n x - S. Values that are nothing but rounding beside the largest count as zero. Of the two signs of
    a vector the one is taken that makes its largest entry positive.
    """
    covariance = np.array([[p / n**3 for p in row] for row in products])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    rounding = len(covariance) * np.finfo(float).eps * max(values[0], 0.0)
    values = np.where(values > rounding, values, 0.0)
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])
    trace = sum(row[j] for j, row in enumerate(products)) / n**3
    return vectors, values, values / trace if trace > 0 else np.zeros(len(values))


def _projected(size: int, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> Callable:
    factor = np.where(values > 0, 1 / np.sqrt(np.where(values > 0, values, 1.0)), np.nan)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, size):
            c = centred(x, n, sums)
            w = ((c / n).astype(np.float64) @ vectors) * factor
            deviation = [int(d) for d in squares(np.ascontiguousarray(c.T))]
            fits = [Decimal(d) if d < 10**38 else None for d in deviation]
            flat = pa.array(w.ravel(), from_pandas=True)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1])
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(fits, pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "deviation", "w"]
            )

    return run


def identity_error(projected: DataFrame, n: int, live: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the columns `live` of w, minus the identity; centred before multiplying."""
    if not live:
        return None
    means = projected.agg(*((F.sum(F.col("w")[i]) / n).alias(f"m{i}") for i in live)).first()
    centre = {i: F.col("w")[i] - F.lit(means[f"m{i}"]) for i in live}
    pairs = [(i, j) for i in live for j in live if i <= j]
    products = projected.agg(*((F.sum(centre[i] * centre[j]) / n).alias(f"p{i}_{j}") for i, j in pairs)).first()
    return max(abs(products[f"p{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Project every vector on the first principal components of all vectors, with unit variance.

    rows: vec_id, x (array of longs within 2^61, not null, without nulls); other columns are ignored. The fit list is all rows of
    the table; repeated rows count as often as they occur, a null id stays null. Vectors of another length than the most
    frequent one (ties: the greater) take no part, as no covariance with them is defined.
    Returns a row per vector and component up to `components` (or the length): vec_id, component (from 1, by falling eigenvalue), n
    (vectors in the fit list), deviation (sum over the dimensions of (n x - S)^2, exact; null beyond 38 digits), whitened
    ((x - S / n) projected, over the root of the eigenvalue), explained (eigenvalue over the trace) and identity_error (one value). A component
    without variance (one vector, constant or dependent dimensions) has a null `whitened` and explained 0, and identity_error covers the others (null
    if there are none). An empty table gives no rows.
    """
    spark = rows.sparkSession
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x")
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if common is None or not common["size"]:
        return spark.createDataFrame([], OUT)
    size, n = common["size"], common["count"]
    rows = rows.where(F.size("x") == size)
    part = "place long, high decimal(38,0), low decimal(38,0)"
    sums = _gather(rows.select("x").mapInArrow(_sums(size), part), size + 1)[1:]
    pairs = size * (size + 1) // 2
    products = polarised(_gather(rows.select("x").mapInArrow(_pair_squares(size, n, sums), part), pairs), size)
    vectors, values, explained = principal(products, n, components)
    projected = written(
        rows.mapInArrow(_projected(size, n, sums, vectors, values), "vec_id long, deviation decimal(38,0), w array<double>"), "projected"
    )
    error = identity_error(projected, n, [int(i) for i in np.flatnonzero(values > 0)])
    share = F.array(*(F.lit(float(e)) for e in explained))
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share[F.col("place")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
