"""Running totals and row positions over ordered rows, without putting an ordered group into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediacat.session import run_dir


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, Column],
    mins: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add to each row the sums of the `totals` columns over the rows of its group up to and including it.

    The sums over the whole group come along as `{name}_total`, the smallest values of the `mins` columns under their names.
    `order` must be unique within a group. Rows are cut into ranges of (group, order), so a group of any size is spread over
    many tasks; each range then needs only the sums of the ranges before it, one row per range and group.
    The ranges come from a sample, so the cut rows are written to the shared folder first: a recomputed range could
    differ from the one its offset was computed for.
    """
    spark, folder = df.sparkSession, run_dir(df.sparkSession, "running")
    mins = mins or {}
    inputs = {f"_in_{name}": value for name, value in {**totals, **mins}.items()}
    cut = df.withColumns(inputs).repartitionByRange(*group, *order)
    # one struct as key: nulls in it are equal, and the window below and the join share one shuffle
    cut = cut.withColumn("_piece", F.struct(F.spark_partition_id().alias("range"), *group))
    cut.write.parquet(folder)
    cut = spark.read.schema(cut.schema).parquet(folder)

    parts = [F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in totals]
    parts += [F.min(f"_in_{name}").alias(f"_min_{name}") for name in mins]
    pieces = cut.groupBy("_piece").agg(*parts)
    whole = Window.partitionBy(*[F.col(f"_piece.{g}") for g in group])
    before = whole.orderBy("_piece.range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col("_piece").alias("_piece_of"),
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_offset_{n}") for n in totals],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"{n}_total") for n in totals],
        *[F.min(f"_min_{n}").over(whole).alias(n) for n in mins],
    )

    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_local_{n}": F.sum(f"_in_{n}").over(inside) for n in totals})
    joined = local.join(offsets, F.col("_piece") == F.col("_piece_of"), "inner")
    running = [(F.col(f"_local_{n}") + F.col(f"_offset_{n}")).alias(n) for n in totals]
    return joined.select(*df.columns, *running, *[f"{n}_total" for n in totals], *mins)


def row_positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """1-based position of each row in the unique order, over the whole table."""
    return running_totals(df, [], order, {name: F.lit(1)}).drop(f"{name}_total")
