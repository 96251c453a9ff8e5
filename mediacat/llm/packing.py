"""Variable-capacity best-fit packing: bins of several permitted lengths, opened and closed at the least cost.

Pieces are dealt evenly to shards of bounded size, and each shard is packed best-fit decreasing. Where no open
bin has room, a bin opens of the length that costs least per unit it can still hope to fill. Every set of lengths
that may be opened is tried; each bin is then brought down to the smallest permitted length that holds its
contents, and the cheapest set of the shard stays.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import text_bytes, written

CAPACITIES = (2048, 4096, 8192, 16384)
SHARD_PIECES = 20_000


def default_cost(capacity: int) -> float:
    """Linear work per position and quadratic work of attention."""
    return capacity + capacity * capacity / 65536


def best_fit(lengths: list[int], openable: tuple[int, ...], costs: Mapping[int, float]) -> tuple[list[int], list[int]]:
    """Bin of each length (given in decreasing order) and the bins' contents."""
    room: dict[int, list[int]] = {}
    free: list[int] = []  # distinct amounts of room, sorted
    bins: list[int] = []
    contents: list[int] = []
    left = sum(lengths)
    largest = openable[-1]
    for length in lengths:
        at = bisect_left(free, length)
        if at < len(free):
            space = free[at]
            stack = room[space]
            number = stack.pop()
            if not stack:
                del room[space]
                del free[at]
        else:
            number, space = len(contents), largest
            best = None
            for capacity in openable:
                if capacity >= length:
                    price = costs[capacity] / min(capacity, left)
                    if best is None or price < best:
                        best, space = price, capacity
            contents.append(0)
        left -= length
        contents[number] += length
        bins.append(number)
        space -= length
        if space:
            if space in room:
                room[space].append(number)
            else:
                room[space] = [number]
                insort(free, space)
    return bins, contents


def pack(lengths: list[int], costs: Mapping[int, float]) -> tuple[list[int], list[int], float]:
    """Bin of each length (decreasing, 1 to the largest capacity), capacity of each bin, and the total cost."""
    sizes = sorted(costs)
    held: tuple | None = None
    for count in range(len(sizes)):
        for others in combinations(sizes[:-1], count):
            bins, contents = best_fit(lengths, (*others, sizes[-1]), costs)
            closed = [sizes[bisect_left(sizes, c)] for c in contents]
            total = sum(costs[c] for c in closed)
            if held is None or total < held[2]:
                held = bins, closed, total
    return held


PACKED = "bin long, position long, capacity long"


def _shard(costs: Mapping[int, float], names: list[str]) -> Callable:
    def run(key: tuple, part: pa.Table) -> pa.Table:
        part = part.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")])
        lengths = part.column("length").to_pylist()
        bins, closed, _ = pack(lengths, costs)
        size = np.array(lengths, np.int64)
        number = np.array(bins, np.int64)
        order = np.argsort(number, kind="stable")
        before = np.cumsum(size[order]) - size[order]
        first = np.flatnonzero(np.append(True, number[order][1:] != number[order][:-1]))
        position = np.empty(len(size), np.int64)
        position[order] = before - np.repeat(before[first], np.diff(np.append(first, len(size))))
        out = {n: part.column(n) for n in names}
        out["bin"] = pa.array((np.int64(key[0].as_py()) << 32) + number)
        out["position"] = pa.array(position)
        out["capacity"] = pa.array(np.array(closed, np.int64)[number])
        return pa.table(out)

    return run


def pieces(docs: DataFrame, largest: int, with_data: bool = False) -> DataFrame:
    """Texts cut into pieces of at most `largest` bytes: doc_id, piece, start, length; an empty text is a piece of length 0."""
    size = F.octet_length("text_").cast("long")
    out = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text_"))
        .select("doc_id", *(["text_"] if with_data else []), size.alias("bytes_"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("bytes_") / largest) - 1, F.lit(0).cast("long")))))
        .withColumn("start", F.col("piece") * largest)
        .withColumn("length", F.least(F.col("bytes_") - F.col("start"), F.lit(largest).cast("long")))
    )
    if with_data:
        out = out.withColumn("data", F.expr("substring(text_, cast(start + 1 as int), cast(length as int))"))
    return out.select("doc_id", "piece", "start", "length", *(["data"] if with_data else []))


def pack_documents(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, cost: Callable[[int], float] = default_cost,
    shard_pieces: int = SHARD_PIECES, with_data: bool = False,
) -> DataFrame:
    """Pack whole documents (as UTF-8 bytes, one position a byte) into sequences of the permitted lengths.

    docs: doc_id long, text; other columns are ignored. Returns one row per piece: doc_id, piece, start and length within
    the document's bytes, bin, position within the bin, capacity of the bin (and the piece's bytes as `data`, if asked).
    Texts above the largest capacity are cut into pieces of that size and a rest. Null and empty texts
    keep their row, with length 0, capacity 0 and no bin. Repeated rows and null ids are packed like others; ties go by
    id and piece. An empty table gives no rows.
    """
    costs = {int(c): float(cost(int(c))) for c in capacities}
    if not costs or min(costs) < 1:
        raise ValueError("capacities must be positive")
    cut = pieces(docs, max(costs), with_data)
    filled = cut.where("length > 0")
    if not with_data:
        cut = written(cut, "pieces")
        filled = cut.where("length > 0")
    shards = max(1, -(-filled.count() // shard_pieces))
    names = [f.name for f in cut.schema.fields]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields), PACKED])
    packed = (
        filled.withColumn("shard_", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(shards)))
        .groupBy("shard_").applyInArrow(_shard(costs, names), schema)
    )
    empty = cut.where("length = 0").select(
        "*", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("long").alias("position"), F.lit(0).cast("long").alias("capacity")
    )
    return packed.unionByName(empty)


def sequences(docs: DataFrame, **options: object) -> DataFrame:
    """The packed sequences: bin, capacity, n_bytes, data (the pieces' bytes in order), documents (id and piece of each).

    No bin holds more than the largest capacity.
    """
    packed = pack_documents(docs, with_data=True, **options).where("bin is not null")
    parts = F.sort_array(F.collect_list(F.struct("position", "doc_id", "piece", "data")))
    return packed.groupBy("bin", "capacity").agg(F.sum("length").alias("n_bytes"), parts.alias("parts")).select(
        "bin", "capacity", "n_bytes",
        F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.data))").alias("data"),
        F.expr("transform(parts, x -> struct(x.doc_id, x.piece))").alias("documents"),
    )
