"""Exact duplicates by Patricia tries whose owners hold one (length, content hash) partition each.

Every task first inserts the full byte strings of its own rows into radix tries, one per (length, hash); a
terminal node keeps the best row of its text, so a text copied into a third of all rows leaves each task as few rows.
Those rows are dealt to their owners by (length, hash) and arrive sorted, so an owner's finished subtrees can leave
memory at any time. Texts are compared byte for byte; the hash only deals them out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import slices, text_bytes, written

# The white space that a comparison ignores.
WHITE = b" \t\n\x0b\x0c\r"
TRIE_BYTES = 32 << 20


class Node:
    __slots__ = ("best", "children", "label")

    def __init__(self, label: bytes, best: list | None = None):
        self.label = label
        self.children: dict[int, Node] = {}
        self.best = best


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def better(a: list, b: list) -> bool:
    """More code points first, then the smaller id, null ids last, then the hash of the original text."""
    return (-a[0], a[1] is None, a[1] or 0, a[2]) < (-b[0], b[1] is None, b[1] or 0, b[2])


class RadixTrie:
    """Compressed trie of byte strings; a terminal holds [code points, id, text hash, rows]."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def insert(self, key: bytes, found: list) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], found)
                self.size += len(key) - at + 200
                return
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = common_prefix(child.label, key[at : at + len(child.label)])
            middle = Node(child.label[:shared])
            child.label = child.label[shared:]
            middle.children[child.label[0]] = child
            node.children[key[at]] = middle
            self.size += 200
            node, at = middle, at + shared
        if node.best is None:
            node.best = found
            return
        rows = node.best[3] + found[3]
        node.best = [*(found if better(found, node.best) else node.best)[:3], rows]

    def spill(self, keep: bytes | None = None) -> Iterator[tuple[bytes, list]]:
        """Emit and drop the subtrees; of those on the path to `keep` only the finished parts beside the path."""
        stack = [(self.root, b"", keep)]
        while stack:
            node, before, path = stack.pop()
            whole = before + node.label
            if node.best is not None and whole != keep:
                yield whole, node.best
                node.best = None
            for first, child in list(node.children.items()):
                if keep is not None and path is not None and keep[len(whole) : len(whole) + 1] == bytes([first]):
                    stack.append((child, whole, path))
                else:
                    del node.children[first]
                    stack.append((child, whole, None))
        self.size = 0 if keep is None else len(keep)


OWNED = "n_bytes long, hash long, norm binary, points long, doc_id long, text_hash long, n_rows long"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


OWNED_ARROW = pa.schema([("n_bytes", pa.int64()), ("hash", pa.int64()), ("norm", pa.binary()), ("points", pa.int64()),
                         ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_rows", pa.int64())])


def _local(hash_bits: int, trie_bytes: int) -> Callable:
    mask = (1 << hash_bits) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[tuple[int, int], RadixTrie] = {}
        size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            rows, held = [], 0
            while tries:
                (length, content), trie = tries.popitem()
                for norm, (points, doc_id, text_hash, n) in trie.spill():
                    rows.append((length, _signed(content), norm, points, doc_id, text_hash, n))
                    held += length + 100
                    if held > 4 << 20:
                        yield _batch(rows, OWNED_ARROW)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, OWNED_ARROW)

        for part in slices(batches, "text", 4 << 20):
            for doc_id, text, points, text_hash in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "points", "text_hash"))):
                norm = text.translate(None, WHITE)
                key = (len(norm), xxhash.xxh64_intdigest(norm) & mask)
                trie = tries.get(key)
                if trie is None:
                    trie = tries[key] = RadixTrie()
                    size += 300
                size -= trie.size
                trie.insert(norm, [points, doc_id, text_hash, 1])
                size += trie.size
                if size > trie_bytes:
                    yield from emptied()
                    size = 0
        yield from emptied()

    return run


FOUND = "text_sha256 string, keep_id long, keep_hash long, group_size long"
FOUND_ARROW = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("keep_hash", pa.int64()), ("group_size", pa.int64())])


def _owner(trie_bytes: int) -> Callable:
    """Rows arrive sorted by (length, hash, bytes)."""

    def row(norm: bytes, best: list) -> tuple:
        return hashlib.sha256(norm).hexdigest(), best[1], best[2], best[3]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, key, rows = RadixTrie(), None, []
        for part in slices(batches, "norm", 4 << 20):
            columns = [part.column(c).to_pylist() for c in ("n_bytes", "hash", "norm", "points", "doc_id", "text_hash", "n_rows")]
            for length, content, norm, points, doc_id, text_hash, n in zip(*columns):
                if (length, content) != key:
                    rows += [row(*x) for x in trie.spill()]
                    trie, key = RadixTrie(), (length, content)
                trie.insert(norm, [points, doc_id, text_hash, n])
                if trie.size > trie_bytes:
                    rows += [row(*x) for x in trie.spill(keep=norm)]
            if rows:
                yield _batch(rows, FOUND_ARROW)
                rows = []
        rows = [row(*x) for x in trie.spill()]
        if rows:
            yield _batch(rows, FOUND_ARROW)

    return run


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", 4 << 20):
        shas = [hashlib.sha256(t.translate(None, WHITE)).hexdigest() for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("text_hash"), pa.array(shas, pa.string())], names=["doc_id", "text_hash", "text_sha256"]
        )


def text_groups(docs: DataFrame, hash_bits: int = 64, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: text_sha256, keep_id, keep_hash (xxhash64 of the kept original), group_size.

    hash_bits: width of the content hash that deals texts to tries (fewer bits put more texts in one trie).
    """
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_bytes().alias("text"),
        F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("points"),
        F.xxhash64(text_bytes()).alias("text_hash"),
    )
    return (
        source.mapInArrow(_local(hash_bits, trie_bytes), OWNED)
        .repartition("n_bytes", "hash")
        .sortWithinPartitions("n_bytes", "hash", "norm")
        .mapInArrow(_owner(trie_bytes), FOUND)
    )


def exact_duplicates(docs: DataFrame, hash_bits: int = 64, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Groups of documents whose texts are equal without the characters of `WHITE`.

    docs: doc_id long, text; other columns are ignored, whatever their names.
    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256.
    Of equal texts the one with the most code points stays, then the one with the smallest id; null ids come last, and
    keep_id is null only if all ids of a group are. Null and blank texts are the empty text. Rows that repeat id and
    text are the same document: each counts in group_size, and they are marked alike. An empty table gives no rows.
    """
    groups = text_groups(docs, hash_bits, trie_bytes)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), F.xxhash64(text_bytes()).alias("text_hash")
    ).mapInArrow(_digest, "doc_id long, text_hash long, text_sha256 string")
    return rows.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("text_hash") == F.col("keep_hash"))).alias("kept"),
        "text_sha256",
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, all columns; of rows that repeat id and text one stays."""
    kept = written(text_groups(docs).select("keep_id", "keep_hash"), "kept-texts")
    return (
        docs.join(
            kept,
            docs["doc_id"].cast("long").eqNullSafe(kept["keep_id"])
            & (F.xxhash64(text_bytes()) == kept["keep_hash"]),
            "left_semi",
        ).dropDuplicates(["doc_id", "text"])
    )
