"""Near duplicates by 64-bit SimHash fingerprints, linked through vantage-point trees.

Fingerprints are cut into three bands; two fingerprints that differ in at most four bits differ in at most one
bit of some band (pigeonhole), so each band has a tree of its own whose distances are Hamming distances on that band. A
node keeps distances up to its radius inside and larger ones outside. By the triangle bound, partners one
bit apart can only be separated if one of them lies in the shell next to the radius, so that shell belongs to both
shards and every pair meets in some shard, where all 64 bits decide. The upper levels of the trees deal fingerprints to
shards; inside a shard the tree is carried on until the leaves are small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import components, slices, text_bytes, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SAMPLE = 1 << 14
"""Fingerprints from which the upper tree levels are made; every fingerprint is dealt and searched."""
SHARD_ROWS = 1 << 14
LEAF_ROWS = 192
SEED = 42


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles: a bit is set if it is set in over half of the shingles' XXH64."""
    words = text.lower().split()  # bytes: A-Z only, and white space is exactly [\x20\x09-\x0D]
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle_words:
        return digest(b" ".join(words), SEED)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle_words + 1].tolist()
    view = memoryview(whole)
    hashes = np.array([digest(view[a:b], SEED) for a, b in zip(starts, ends[shingle_words - 1 :].tolist())], np.uint64)
    half = len(hashes) / 2
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits > half, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle_words: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            found = np.array([fingerprint(t, shingle_words) for t in part.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"]
            )

    return run


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), fp (the fingerprint as a signed long), one row per document."""
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), F.xxhash64(text_bytes()).alias("text_hash")
    )
    return source.mapInArrow(_fingerprints(shingle_words), "doc_id long, text_hash long, fp long")


def bands(max_bits: int) -> tuple[list[int], int]:
    """Masks of the bands and the radius within which some band of a linked pair lies."""
    count = max(1, (max_bits + 2) // 2)  # the fewest bands in which one differing bit is the most that must be met
    edges = [64 * i // count for i in range(count + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return masks, max_bits // count


def _distances(values: np.ndarray, point: np.uint64 | np.ndarray, mask: int) -> np.ndarray:
    return np.bitwise_count((values ^ point) & np.uint64(mask))


def _radius(distances: np.ndarray) -> int | None:
    """The radius that halves best, or None if all distances are equal."""
    counts = np.bincount(distances, minlength=65).cumsum()
    if counts[int(distances.min())] == len(distances):
        return None
    inside = counts[:-1].astype(np.float64)
    inside[(inside == 0) | (inside == len(distances))] = np.inf
    return int(np.argmin(np.abs(inside - len(distances) / 2)))


def upper_tree(sample: np.ndarray, mask: int, depth: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage point, radius, child inside, child outside); radius -1 marks a leaf."""
    nodes: list[list[int]] = [[0, -1, 0, 0]]
    todo = [(0, sample, depth)]
    while todo:
        at, values, left = todo.pop()
        if left == 0 or len(values) < 8:
            continue
        point = values[0]
        distances = _distances(values, point, mask)
        radius = _radius(distances)
        if radius is None:
            continue
        nodes[at] = [int(point), radius, len(nodes), len(nodes) + 1]
        nodes += [[0, -1, 0, 0], [0, -1, 0, 0]]
        todo += [(nodes[at][2], values[distances <= radius], left - 1), (nodes[at][3], values[distances > radius], left - 1)]
    return [tuple(n) for n in nodes]


def _shards(trees: list, masks: list[int], reach: int) -> Callable:
    """Every fingerprint to its shard of each band, and to those whose boundary shell it lies in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [tuple(np.array([n[i] for n in tree], np.uint64 if i == 0 else np.int64) for i in range(4)) for tree in trees]
        first = np.cumsum([0, *(len(t) for t in trees)])
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for (points, radii, inside, outside), mask, offset in zip(arrays, masks, first):
                rows, node = np.arange(len(values)), np.zeros(len(values), np.int64)
                while len(rows):
                    leaf = radii[node] < 0
                    if leaf.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(node[leaf] + offset), pa.array(values[rows[leaf]].view(np.int64))], names=["shard", "fp"]
                        )
                        rows, node = rows[~leaf], node[~leaf]
                        if not len(rows):
                            break
                    distances = _distances(values[rows], points[node], mask).astype(np.int64)
                    near, far = distances <= radii[node] + reach, distances > radii[node]
                    rows, node = np.concatenate((rows[near], rows[far])), np.concatenate((inside[node[near]], outside[node[far]]))

    return run


def _leaf_links(values: np.ndarray, max_bits: int) -> np.ndarray:
    """Links of a leaf, one per member of each of its components at most: (member, smallest member)."""
    n = len(values)
    if n > 1 << 13:  # too large for one matrix: rows against all, block by block, until labels are stable
        label = np.arange(n)
        while True:
            new = label.copy()
            for at in range(0, n, 256):
                near = np.bitwise_count(values[at : at + 256, None] ^ values[None, :]) <= max_bits
                new[at : at + 256] = np.where(near, new[None, :], n).min(axis=1)
            if (new == label).all():
                break
            label = new
    else:
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        lone = near.sum(axis=1) == 1
        if lone.all():
            return np.empty((0, 2), np.uint64)
        label = np.arange(n)
        while True:
            new = np.where(near, label[None, :], n).min(axis=1)
            if (new == label).all():
                break
            label = new
    linked = label != np.arange(n)
    return np.stack((values[linked], values[label[linked]]), axis=1)


def shard_links(values: np.ndarray, mask: int, reach: int, max_bits: int, leaf_rows: int = LEAF_ROWS) -> np.ndarray:
    """Carry the tree of one band on inside a shard; links of all its leaves."""
    found, todo = [], [(np.unique(values), mask, reach)]
    while todo:
        part, bits, shell = todo.pop()
        if len(part) <= leaf_rows:
            found.append(_leaf_links(part, max_bits))
            continue
        distances = _distances(part, part[len(part) // 2], bits)
        radius = _radius(distances)
        if radius is not None:
            near, far = part[distances <= radius + shell], part[distances > radius]
            if max(len(near), len(far)) < 0.95 * len(part):
                todo += [(near, bits, shell), (far, bits, shell)]
                continue
        if bits == mask and mask != (1 << 64) - 1:  # the band tells no more apart: go on with all bits
            todo.append((part, (1 << 64) - 1, max_bits))
        else:
            found.append(_leaf_links(part, max_bits))
    links = [f for f in found if len(f)]
    return np.unique(np.concatenate(links), axis=0) if links else np.empty((0, 2), np.uint64)


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links u, v between fingerprints (column fp, distinct) within `max_bits`.

    Of all the pairs of a shard it returns as many as connect what they connect: one link per member and shard leaf.
    """
    masks, reach = bands(max_bits)
    count = distinct.count()
    depth = max(0, int(np.ceil(np.log2(max(1, count) / shard_rows))) + 2) if count > shard_rows else 0
    sample = np.array(
        [r["fp"] for r in distinct.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], np.int64
    ).view(np.uint64)
    trees = [upper_tree(sample, mask, depth) for mask in masks]
    first = np.cumsum([0, *(len(t) for t in trees)])

    def links(key: tuple, part: pa.Table) -> pa.Table:
        band = int(np.searchsorted(first, key[0].as_py(), side="right")) - 1
        values = part.column("fp").to_numpy().view(np.uint64)
        pairs = shard_links(values, masks[band], reach, max_bits).view(np.int64)
        return pa.table({"u": pairs[:, 0], "v": pairs[:, 1]})

    return (
        distinct.select("fp").mapInArrow(_shards(trees, masks, reach), "shard long, fp long")
        .groupBy("shard").applyInArrow(links, "u long, v long")
    )


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Components of documents whose fingerprints differ in at most `max_bits` bits.

    docs: doc_id long, text; other columns are ignored. Returns one row per input row: doc_id, fingerprint (16
    lowercase hex digits), component_id (smallest id that can be reached, its own included), text_hash (xxhash64).
    Null and blank texts have the fingerprint zero and are linked like any other. Null ids come after all others: a
    component_id is null only if no member has an id. Repeated rows appear as often as they are given.
    An empty table gives no rows.
    """
    prints = written(fingerprints(docs, shingle_words), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    roots = components(fingerprint_links(classes, max_bits))
    rooted = written(
        classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "fingerprint-roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = written(rooted.join(smallest, "root").select("fp", "component_id"), "fingerprint-components")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_hash"
    )


def keep_one_of_each_component(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, all columns.

    Rows are told apart by id and text. Documents without an id stay if no member of their component has one.
    """
    found = near_duplicates(docs)
    dropped = written(
        found.where(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash")).distinct(),
        "near-copies",
    )
    return docs.join(
        dropped,
        docs["doc_id"].cast("long").eqNullSafe(dropped["dropped_id"]) & (F.xxhash64(text_bytes()) == dropped["dropped_hash"]),
        "left_anti",
    )
