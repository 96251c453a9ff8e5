"""Repeated passages by suffix sorting: bytes covered by a span that also starts in a document with a smaller id.

1. Documents are packed into chunks of some megabytes, written once.
2. In every chunk each window of `SPAN` bytes names its smallest 16-byte gram (by a hash): the anchors, about one byte in
   eighteen. Equal windows name the same gram at the same place. Each chunk sends the distinct fingerprints of its
   anchors to hash buckets and learns which occur elsewhere.
3. Those anchors are sent again with the bytes around them that a window through the anchor can reach, equal contexts
   of a chunk once with their smallest id. A bucket sorts the suffixes that begin at the anchors, and the reversed
   prefixes before them, deep-shallow: multikey quicksort by 8-byte characters to a shallow depth, then blind tries for what
   still agrees. From the longest common prefixes of neighbours follow the classes of equal windows at every
   offset, and of each class the smallest id. Bytes decide, never hashes.
4. A gram that stands more than `HOT_ROWS` times is dealt by chunk over as many salts as it takes. Each salt is resolved like
   a bucket. Of the windows for which a salt knows no smaller id it sends distinct fingerprints and learns which occur in another
   salt; only those meet by their bytes and learn the smallest id of all salts.
5. Every context gets back one bit per window; the chunk marks the bytes.

Nothing passes the driver but one byte count. A text stays in one chunk, however long it is.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import LAST_ID, flat, ids, slices, text_bytes, written

SPAN = 50
GRAM = 16
SHALLOW_WORDS = 4
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 12 << 20
BLOCK = 1 << 17
HOT_ROWS = 1 << 14
SALT_BITS = 24


def _mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of each `width` neighbours, by doubling."""
    step = 1
    while step * 2 <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return pick(x[:-rest], x[rest:]) if rest else x


def _gram_hashes(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Hashes of grams by their two 8-byte words."""
    h = (head * np.uint64(0x9E3779B97F4A7C15)) ^ (tail * np.uint64(0xC2B2AE3D27D4EB4F))
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xFF51AFD7ED558CCD)


def _gram_ranks(grams: np.ndarray) -> np.ndarray:
    """What the least gram of a window is chosen by, for byte rows [n, GRAM]."""
    words = np.ascontiguousarray(grams).view("<u8")
    return (_gram_hashes(words[:, 0], words[:, 1]) >> np.uint64(32)).astype(np.uint32)


def find_anchors(data: np.ndarray, ends: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, 64-bit gram hashes and document numbers of the anchors. ends: offsets of the documents in `data`."""
    windows = span - GRAM + 1
    grams = len(data) - GRAM + 1
    places, hashes = [], []
    for a in range(0, max(0, grams), BLOCK):
        low, high = max(0, a - windows + 1), min(grams, a + BLOCK + windows - 1)
        if high - low < windows:
            low = max(0, high - windows)
        if high - low < windows:
            break  # shorter than one span
        part = data[low : high + GRAM - 1]
        words = np.ndarray((len(part) - 7,), "<u8", buffer=part, strides=(1,)).copy()
        h = _gram_hashes(words[:-8], words[8:])
        order = (h >> np.uint64(32)).astype(np.uint32)
        least = _sliding(order, windows, np.minimum)
        edge = np.zeros(windows - 1, np.uint32)
        named = order == _sliding(np.concatenate((edge, least, edge)), windows, np.maximum)
        at = np.flatnonzero(named[a - low : min(a + BLOCK, grams) - low]) + (a - low)
        places.append(at + low)
        hashes.append(h[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    place, hashed = np.concatenate(places), np.concatenate(hashes)
    doc = np.searchsorted(ends, place, side="right") - 1
    inside = (place + GRAM <= ends[doc + 1]) & (ends[doc + 1] - ends[doc] >= span)
    return place[inside], _mix(hashed[inside]), doc[inside]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def blind_trie_order(strings: list[bytes]) -> list[list[int]]:
    """Members of equal strings, in the order of the strings (all of one length).

    A node keeps the place at which its strings first differ and one child per byte there; the way down looks at these
    bytes only, and one comparison with the leaf that is reached tells where the new string branches off.
    """
    root: list = [strings[0], [0]]  # leaf: [string, members]; node: (place, children)
    for number, text in enumerate(strings[1:], start=1):
        node = root
        while isinstance(node, tuple):
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        leaf = node[0]
        if leaf == text:
            node[1].append(number)
            continue
        low, high = 0, len(text)
        while high - low > 1:
            mid = (low + high) // 2
            if leaf[low:mid] == text[low:mid]:
                low = mid
            else:
                high = mid
        branch = low
        parent, node = None, root
        while isinstance(node, tuple) and node[0] < branch:
            parent, node = node, node[1][text[node[0]]]
        if isinstance(node, tuple) and node[0] == branch:
            node[1][text[branch]] = [text, [number]]
            continue
        fresh = (branch, {leaf[branch]: node, text[branch]: [text, [number]]})
        if parent is None:
            root = fresh
        else:
            parent[1][text[parent[0]]] = fresh
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        else:
            out.append(node[1])
    return out


def multikey_quicksort(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows [n, width] by their first `depth` words, and where a row differs from the one before it.

    Every group of rows that agree on the words before its own depth is parted by a pivot word into less, equal and greater;
    the equal part goes on with the next word, the others with the same one. All groups are parted in one pass.
    """
    n = len(words)
    order, fresh = np.arange(n), np.zeros(n, bool)
    fresh[:1] = True
    pick = np.random.default_rng(11)
    at, sizes, level = np.arange(n), np.array([n]), np.zeros(1, np.int64)
    if n < 2 or depth < 1:
        return order, fresh
    while len(at):
        starts, group = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
        members = order[at]
        word = words[members, level[group]]
        one, two, three = (word[starts + (pick.random(len(sizes)) * sizes).astype(np.int64)] for _ in range(3))
        pivot = np.maximum(np.minimum(one, two), np.minimum(np.maximum(one, two), three))[group]
        side = (word >= pivot).astype(np.int8) + (word > pivot)
        counts = np.bincount(group * 3 + side, minlength=3 * len(sizes)).reshape(-1, 3)
        begin = (np.cumsum(counts) - counts.ravel()).reshape(-1, 3)
        parted = np.empty_like(members)
        for k in range(3):
            mine = np.flatnonzero(side == k)
            of = group[mine]
            parted[begin[of, k] + np.arange(len(mine)) - (np.cumsum(counts[:, k]) - counts[:, k])[of]] = members[mine]
        order[at] = parted
        fresh[at[begin[counts > 0]]] = True
        deeper = (level[:, None] + np.array([0, 1, 0])).ravel()
        sizes = counts.ravel()
        goes_on = (sizes > 1) & (deeper < depth)
        at = at[np.repeat(goes_on, sizes)]
        sizes, level = sizes[goes_on], deeper[goes_on]
    return order, fresh


def deep_shallow(rows: np.ndarray, shallow_words: int = SHALLOW_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sort byte rows [n, length]; the order and the longest common prefix of each row with the one before it (first: 0)."""
    n, length = rows.shape
    wide = np.zeros((n, -(-length // 8) * 8), np.uint8)
    wide[:, :length] = rows
    words = wide.view(">u8").astype(np.uint64)
    order, fresh = multikey_quicksort(words, min(shallow_words, words.shape[1]))
    at = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
    if len(at) and shallow_words < words.shape[1]:
        group = np.cumsum(fresh)[at]
        starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(starts, len(at)))
        rest = words[order[at], shallow_words:]
        differs = (rest != rest[np.repeat(starts, sizes)]).any(axis=1)
        mixed = np.logical_or.reduceat(differs, starts)
        tail = np.ascontiguousarray(rows[:, shallow_words * 8 :])
        span = tail.shape[1]
        for start, size in zip(starts[mixed].tolist(), sizes[mixed].tolist()):
            members = order[at[start : start + size]]
            block = tail[members].tobytes()
            sorted_members = blind_trie_order([block[i * span : (i + 1) * span] for i in range(size)])
            order[at[start : start + size]] = members[[i for same in sorted_members for i in same]]
    common = np.zeros(n, np.int64)
    for a in range(1, n, 1 << 16):
        b = min(n, a + (1 << 16))
        differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        common[a:b] = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return order, common


def _classes(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """A number for each row, the same for rows that agree on the first `length` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < length)
    return out


_ROW_WORDS = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    words = wide.view("<u8")
    total = np.zeros(len(rows), np.uint64)
    for i in range(words.shape[1]):
        total += _mix(words[:, i] ^ _ROW_WORDS[i % 64])
        total *= _ROW_WORDS[(i + 1) % 64]
    return total


def _equal_to_last(rows: np.ndarray) -> np.ndarray:
    same = np.zeros(len(rows), bool)
    for a in range(1, len(rows), 1 << 16):
        b = min(len(rows), a + (1 << 16))
        same[a:b] = (rows[a:b] == rows[a - 1 : b - 1]).all(axis=1)
    return same


class Contexts:
    """The candidate anchors of one chunk: equal contexts are one entry, entries are ordered by route.

    A route is a bucket and a salt: 0, or for a hot gram one from 1 on, by the chunk.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray, doc_ids: np.ndarray, bits: dict[int, tuple[bytes, bytes]], buckets: int, span: int, chunk: int):
        left, reach = span - GRAM, 2 * span - GRAM
        place, hashed, doc = find_anchors(data, ends, span)
        distinct, inverse, count = np.unique(hashed, return_inverse=True, return_counts=True)
        wanted = count > 1
        bucket = _bucket(distinct, buckets)
        route = bucket << SALT_BITS
        for number, (packed, salts) in bits.items():
            a, b = np.searchsorted(bucket, (number, number + 1))
            wanted[a:b] |= np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a).astype(bool)
            if salts:
                parts = np.frombuffer(salts, np.uint32).astype(np.uint64)
                dealt = _mix(distinct[a:b] ^ np.uint64(chunk)) % np.maximum(parts, np.uint64(1))
                route[a:b] += np.where(parts > 0, dealt + np.uint64(1), np.uint64(0)).astype(np.int64)
        chosen = wanted[inverse] if len(place) else np.zeros(0, bool)
        self.place, doc = place[chosen], doc[chosen]
        self.doc_id = doc_ids[doc]
        of_route = route[inverse[chosen]] if len(place) else np.zeros(0, np.int64)
        before = np.minimum(self.place - ends[doc], left)
        after = np.minimum(ends[doc + 1] - self.place, span)
        padded = np.concatenate((np.zeros(left, np.uint8), data, np.zeros(span, np.uint8)))
        rows = np.empty((len(self.place), reach + 2), np.uint8)
        if len(self.place):
            rows[:, :reach] = np.lib.stride_tricks.sliding_window_view(padded, reach)[self.place]
        for i in np.flatnonzero((before < left) | (after < span)):
            rows[i, : left - before[i]] = 0
            rows[i, left + after[i] : reach] = 0
        rows[:, reach], rows[:, reach + 1] = before, after
        order = np.lexsort((_row_hashes(rows), of_route))
        rows, of_route = rows[order], of_route[order]
        new = ~_equal_to_last(rows)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.rows, self.route = rows[first], of_route[first]
        self.least = np.minimum.reduceat(self.doc_id[order], first) if len(first) else np.empty(0, np.int64)
        self.before, self.after = before, after


def window_bits(rows: np.ndarray, doc_ids: np.ndarray, span: int = SPAN) -> np.ndarray:
    """For each context, bit s: the window that starts s bytes into it also starts in a document with a smaller id."""
    left, reach = span - GRAM, 2 * span - GRAM
    order = np.argsort(_row_hashes(rows), kind="stable")
    new = ~_equal_to_last(rows[order])
    context = np.empty(len(rows), np.int64)
    context[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(doc_ids[order], first)
    rows = rows[order[first]]
    before, after = rows[:, reach].astype(np.int64), rows[:, reach + 1].astype(np.int64)
    right_order, right_common = deep_shallow(np.ascontiguousarray(rows[:, left:reach]))
    gram = _classes(right_order, right_common, GRAM)
    many = np.flatnonzero(np.bincount(gram)[gram] > 1)  # the others have no partner but their equals
    left_order, left_common = deep_shallow(np.ascontiguousarray(rows[many, left - 1 :: -1])) if len(many) else (many, many)
    bits = np.zeros(len(doc_ids), np.uint64)
    for s in range(left + 1):
        valid = (before >= left - s) & (after >= s + GRAM)
        smallest = least.copy()
        if len(many):
            key = _classes(right_order, right_common, s + GRAM)[many] * (len(many) + 1) + _classes(left_order, left_common, left - s)
            use = np.flatnonzero(valid[many])
            if len(use):
                by = use[np.argsort(key[use], kind="stable")]
                starts = np.flatnonzero(np.append(True, key[by[1:]] != key[by[:-1]]))
                found = np.minimum.reduceat(least[many[by]], starts)
                smallest[many[by]] = np.repeat(found, np.diff(np.append(starts, len(by))))
        hit = valid[context] & (smallest[context] < doc_ids)
        bits |= hit.astype(np.uint64) << np.uint64(s)
    return bits


def open_windows(rows: np.ndarray, bits: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and places s of the windows that name the gram of their context and have no bit.

    A window lies in the contexts of all grams it holds; of these it names the ones with the least hash, and so do equal windows.
    """
    left, reach = span - GRAM, 2 * span - GRAM
    before, after = rows[:, reach].astype(np.int64), rows[:, reach + 1].astype(np.int64)
    ranks = np.stack([_gram_ranks(rows[:, i : i + GRAM]) for i in range(reach - GRAM + 1)], axis=1)
    own = ranks[:, left]
    back, ahead = np.minimum.accumulate(ranks[:, left::-1], axis=1), np.minimum.accumulate(ranks[:, left:], axis=1)
    contexts, places = [], []
    for s in range(left + 1):
        named = (back[:, left - s] >= own) & (ahead[:, s] >= own)
        unset = (bits >> np.uint64(s)) & np.uint64(1) == 0
        at = np.flatnonzero(named & unset & (before >= left - s) & (after >= s + GRAM))
        contexts.append(at)
        places.append(np.full(len(at), s))
    return np.concatenate(contexts), np.concatenate(places)


def _pack(column: str, chunk_bytes: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        held: list[pa.RecordBatch] = []
        size = 0

        def packed() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            data, ends = flat(rows.column(column).combine_chunks())
            sink = pa.BufferOutputStream()
            others = rows.drop_columns([column])
            with pa.ipc.new_stream(sink, others.schema) as stream:
                stream.write_table(others)
            values = [[uuid.uuid4().int >> 65], [len(data)], [press.compress(sink.getvalue().to_pybytes())], [ends.tobytes()], [press.compress(data.tobytes())]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["chunk", "size", "rows", "ends", "data"]
            )

        for part in slices(batches, column, chunk_bytes):
            held.append(part)
            size += sum(len(v) for v in part.column(column).to_pylist()) + 200 * part.num_rows
            if size >= chunk_bytes:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    return run


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Table, dict]]:
    """Chunk number, bytes, offsets, other columns and bits (if joined) of every row."""
    grow = zstandard.ZstdDecompressor()
    for row in batch.to_pylist():
        data = np.frombuffer(grow.decompress(row["data"]) if row["data"] else b"", np.uint8)
        rows = pa.ipc.open_stream(grow.decompress(row["rows"])).read_all()
        bits = {x["bucket"]: (x["packed"], x["salts"]) for x in row.get("bits") or ()}
        yield row["chunk"], data, np.frombuffer(row["ends"], np.int64), rows, bits


def _send_fingerprints(buckets: int, span: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data, ends, *_ in _chunks(batch):
                distinct, times = np.unique(find_anchors(data, ends, span)[1], return_counts=True)
                bucket = _bucket(distinct, buckets)
                starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
                blobs, counts = ([x[a:b].tobytes() for a, b in zip(starts, np.append(starts[1:], len(bucket)))] for x in (distinct.astype(np.uint32), times.astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[starts]), pa.array(np.full(len(starts), chunk)), pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())],
                    names=["bucket", "chunk", "packed", "times"],
                )

    return run


def _shared(hot_rows: int) -> Callable:
    """Of each chunk's fingerprints, which occur in another chunk, and over how many salts the hot ones are dealt (0: not hot)."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(b, np.uint32) for b in part.column("packed").to_pylist()]
        values = np.concatenate(blobs)
        times = np.concatenate([np.frombuffer(b, np.uint32) for b in part.column("times").to_pylist()]).astype(np.int64)
        order = np.argsort(values, kind="stable")
        starts = np.flatnonzero(np.append(True, values[order[1:]] != values[order[:-1]]))
        sizes = np.diff(np.append(starts, len(order)))
        total = np.add.reduceat(times[order], starts)
        twice, salts = np.empty(len(values), bool), np.empty(len(values), np.uint32)
        twice[order] = np.repeat(sizes > 1, sizes)
        salts[order] = np.repeat(np.where((sizes > 1) & (total > hot_rows), -(-total // hot_rows), 0), sizes)
        out, at = [], 0
        for chunk, blob in zip(part.column("chunk").to_pylist(), blobs):
            mine, dealt = twice[at : at + len(blob)], salts[at : at + len(blob)]
            at += len(blob)
            if mine.any():
                out.append((chunk, np.packbits(mine).tobytes(), dealt.tobytes() if dealt.any() else b""))
        return pa.table({
            "bucket": pa.array([key[0].as_py()] * len(out), pa.int64()), "chunk": pa.array([o[0] for o in out], pa.int64()),
            "packed": pa.array([o[1] for o in out], pa.binary()), "salts": pa.array([o[2] for o in out], pa.binary()),
        })

    return run


def _send_contexts(buckets: int, span: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for chunk, data, ends, rows, bits in _chunks(batch):
                found = Contexts(data, ends, ids(rows.column("doc_id").combine_chunks()), bits, buckets, span, chunk)
                starts = np.flatnonzero(np.append(True, found.route[1:] != found.route[:-1])) if len(found.route) else np.empty(0, np.int64)
                stops = np.append(starts[1:], len(found.route))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.route[starts]), pa.array(np.full(len(starts), chunk)), pa.array(starts, pa.int64()),
                        pa.array([press.compress(found.rows[a:b].tobytes()) for a, b in zip(starts, stops)], pa.binary()),
                        pa.array([found.least[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
                    ],
                    names=["route", "chunk", "first", "rows", "ids"],
                )

    return run


RESOLVED = "route long, chunk long, packed binary, contexts binary, ids binary, origins binary, entries binary, at binary, places binary"
"""One row of bits for each chunk of a route; of a salted route also one row of the contexts with open windows, and these windows."""


def _resolve(span: int) -> Callable:
    width = 2 * span - GRAM + 2

    def run(key: tuple, part: pa.Table) -> pa.Table:
        grow, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        chunks = part.column("chunk").to_pylist()
        least = [np.frombuffer(b, np.int64) for b in part.column("ids").to_pylist()]
        blobs = part.column("rows").to_pylist()
        rows = np.concatenate([np.frombuffer(grow.decompress(b), np.uint8).reshape(-1, width) for b in blobs])
        doc_ids = np.concatenate(least)
        bits = window_bits(rows, doc_ids, span)
        sizes = [len(x) for x in least]
        stops = np.cumsum(sizes)
        packed = [bits[b - n : b].tobytes() for n, b in zip(sizes, stops)]
        route, n = key[0].as_py(), len(packed)
        rest = ("contexts", "ids", "origins", "entries", "at", "places")
        masks = pa.table({
            "route": pa.array([route] * n, pa.int64()), "chunk": pa.array(chunks, pa.int64()), "packed": pa.array(packed, pa.binary()),
            **{name: pa.nulls(n, pa.binary()) for name in rest},
        })
        if not route & ((1 << SALT_BITS) - 1):
            return masks
        at, places = open_windows(rows, bits, span)
        if not len(at):
            return masks
        first = np.array(part.column("first").to_pylist(), np.int64)
        entry = np.arange(len(rows)) + np.repeat(first - (stops - sizes), sizes)
        used, at = np.unique(at, return_inverse=True)
        blobs = (
            press.compress(rows[used].tobytes()), doc_ids[used].tobytes(), np.repeat(np.array(chunks, np.int64), sizes)[used].tobytes(),
            entry[used].tobytes(), at.astype(np.int32).tobytes(), places.astype(np.uint8).tobytes(),
        )
        return pa.concat_tables([masks, pa.table({
            "route": pa.array([route], pa.int64()), "chunk": pa.nulls(1, pa.int64()), "packed": pa.nulls(1, pa.binary()),
            **{name: pa.array([blob], pa.binary()) for name, blob in zip(rest, blobs)},
        })])

    return run


def _windows_of(row: dict, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, places, bytes and hashes of the open windows of a salted route, in the order of the hashes, and where a hash differs from the one before it."""
    contexts = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["contexts"]), np.uint8).reshape(-1, 2 * span - GRAM + 2)
    at, places = np.frombuffer(row["at"], np.int32), np.frombuffer(row["places"], np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(contexts, span, axis=1)[at, places]
    hashes = _row_hashes(windows)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    return at[order], places[order], windows[order], hashes, np.append(True, hashes[1:] != hashes[:-1])


def _send_window_fingerprints(parts: int, span: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                *_, hashes, new = _windows_of(row, span)
                distinct = hashes[new]
                edges = np.searchsorted(_bucket(distinct, parts), np.arange(parts + 1))
                filled = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(filled, pa.int64()), pa.array(np.full(len(filled), row["route"]), pa.int64()),
                        pa.array([distinct[edges[k] : edges[k + 1]].astype(np.uint32).tobytes() for k in filled], pa.binary()),
                    ],
                    names=["part", "route", "packed"],
                )

    return run


def _met(key: tuple, part: pa.Table) -> pa.Table:
    """Of each salted route's fingerprints, which occur in another route."""
    blobs = [np.frombuffer(b, np.uint32) for b in part.column("packed").to_pylist()]
    _, inverse, counts = np.unique(np.concatenate(blobs), return_inverse=True, return_counts=True)
    # hashes that agree by chance are only asked for in vain
    bits = np.split(counts[inverse] > 1, np.cumsum([len(b) for b in blobs])[:-1])
    out = [(route, np.packbits(b).tobytes()) for route, b in zip(part.column("route").to_pylist(), bits) if b.any()]
    return pa.table({
        "part": pa.array([key[0].as_py()] * len(out), pa.int64()), "route": pa.array([o[0] for o in out], pa.int64()), "packed": pa.array([o[1] for o in out], pa.binary()),
    })


def _send_windows(parts: int, span: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for row in batch.to_pylist():
                at, places, windows, hashes, new = _windows_of(row, span)
                ids_, origins, entries = (np.frombuffer(row[name], np.int64)[at] for name in ("ids", "origins", "entries"))
                of_part, numbers = _bucket(hashes[new], parts), np.cumsum(new) - 1
                found = []
                for met in row["met"]:
                    a, b = np.searchsorted(of_part, (met["part"], met["part"] + 1))
                    asked = np.zeros(len(of_part), bool)
                    asked[a:b] = np.unpackbits(np.frombuffer(met["packed"], np.uint8), count=b - a).astype(bool)
                    mine = np.flatnonzero(asked[numbers])
                    found.append((met["part"], press.compress(windows[mine].tobytes()), *(x[mine].tobytes() for x in (ids_, origins, entries, places))))
                names = ["part", "windows", "ids", "origins", "entries", "places"]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if k else pa.int64()) for k, x in enumerate(zip(*found))], names=names)

    return run


def _least(span: int) -> Callable:
    """For each chunk the contexts in which a window that met also starts in a document with a smaller id, and the bits of these windows."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        grow = zstandard.ZstdDecompressor()
        windows = np.frombuffer(b"".join(grow.decompress(b) for b in part.column("windows").to_pylist()), np.uint8).reshape(-1, span)
        doc_ids, origins, entries = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.int64) for c in ("ids", "origins", "entries"))
        places = np.frombuffer(b"".join(part.column("places").to_pylist()), np.uint8)
        same = _classes(*deep_shallow(windows), span)
        least = np.full(same.max() + 1, LAST_ID)
        np.minimum.at(least, same, doc_ids)
        hit = np.flatnonzero(least[same] < doc_ids)
        hit = hit[np.lexsort((entries[hit], origins[hit]))]
        origins, entries, bits = origins[hit], entries[hit], np.uint64(1) << places[hit].astype(np.uint64)
        new = np.flatnonzero(np.append(True, (origins[1:] != origins[:-1]) | (entries[1:] != entries[:-1]))) if len(hit) else hit
        bits = np.bitwise_or.reduceat(bits, new) if len(hit) else bits
        origins, entries = origins[new], entries[new]
        chunks, starts = np.unique(origins, return_index=True)
        stops = np.append(starts[1:], len(origins))
        return pa.table({
            "chunk": pa.array(chunks, pa.int64()), "entries": pa.array([entries[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
            "bits": pa.array([bits[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
        })

    return run


def whole_characters(text: bytes, spans: list[dict]) -> bytes:
    """What stays of a text if a character goes only when all its bytes are in one removed span."""
    out, at = [], 0
    for span in spans:
        start, stop = span["start"], span["stop"]
        while start < stop and text[start] & 0xC0 == 0x80:  # the rest of a character whose head stays
            start += 1
        while stop > start and stop < len(text) and text[stop] & 0xC0 == 0x80:  # a head whose rest stays
            stop -= 1
        out.append(text[at:start])
        at = stop
    out.append(text[at:])
    return b"".join(out)


def _mark(buckets: int, span: int, keep: str | None, names: list[str]) -> Callable:
    left = span - GRAM

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = zip(_chunks(batch), batch.column("masks").to_pylist(), batch.column("late").to_pylist())
            for (chunk, data, ends, rows, bits), masks, late in joined:
                found = Contexts(data, ends, ids(rows.column("doc_id").combine_chunks()), bits, buckets, span, chunk)
                mask = np.zeros(len(found.rows), np.uint64)
                for part in masks or ():
                    a, b = np.searchsorted(found.route, (part["route"], part["route"] + 1))
                    mask[a:b] = np.frombuffer(part["packed"], np.uint64)
                for part in late or ():
                    mask[np.frombuffer(part["entries"], np.int64)] |= np.frombuffer(part["bits"], np.uint64)
                later = found.doc_id > found.least[found.entry] if len(found.entry) else np.zeros(0, bool)
                mine = mask[found.entry] if len(found.entry) else np.zeros(0, np.uint64)
                change = np.zeros(len(data) + 1, np.int32)
                starts_here = np.zeros(len(data) + 1, bool)
                for s in range(left + 1):
                    hit = ((mine >> np.uint64(s)) & np.uint64(1)).astype(bool)
                    hit |= later & (found.before >= left - s) & (found.after >= s + GRAM)
                    starts_here[found.place[hit] - left + s] = True
                starts = np.flatnonzero(starts_here)
                change[starts] += 1
                change[starts + span] -= 1
                removed = np.cumsum(change[:-1]) > 0
                opens = removed.copy()
                opens[1:] &= ~removed[:-1]
                heads = ends[:-1][ends[1:] > ends[:-1]]
                opens[heads] = removed[heads]
                closes = removed.copy()
                closes[:-1] &= ~removed[1:]
                tails = heads - 1
                closes[tails[tails >= 0]] = removed[tails[tails >= 0]]
                total, edges = (np.concatenate(([0], np.cumsum(x))) for x in (removed, opens))
                open_at, close_at = np.flatnonzero(opens), np.flatnonzero(closes) + 1
                kept, shas, spans = [], [], []
                for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                    text = data[a:b] if total[b] == total[a] else data[a:b][~removed[a:b]]
                    raw = text.tobytes()
                    shas.append(hashlib.sha256(raw).hexdigest())
                    mine = zip(open_at[edges[a] : edges[b]].tolist(), close_at[edges[a] : edges[b]].tolist())
                    spans.append([{"start": x - a, "stop": y - a} for x, y in mine])
                    if keep == "characters" and spans[-1]:
                        raw = whole_characters(data[a:b].tobytes(), spans[-1])
                    kept.append(raw if keep else None)
                columns = [rows.column(n).combine_chunks() for n in names]
                columns += [pa.array(np.diff(ends)), pa.array(np.diff(total[ends])), pa.array(np.diff(edges[ends]))]
                columns += [pa.array(shas, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
                columns.append(pa.array(kept, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    return run


def _resolved(docs: DataFrame, text: str, span: int, chunk_bytes: int, bucket_bytes: int, hot_rows: int, keep: str | None) -> DataFrame:
    """`docs` has doc_id (long) and the binary column `text`; its other columns are carried along."""
    names = [c for c in docs.columns if c != text]
    chunks = written(docs.mapInArrow(_pack(text, chunk_bytes), "chunk long, size long, rows binary, ends binary, data binary"), "chunks")
    buckets = max(8, -(-(chunks.agg(F.sum("size")).first()[0] or 0) // bucket_bytes))
    chunks = chunks.drop("size")
    bits = written(
        chunks.mapInArrow(_send_fingerprints(buckets, span), "bucket long, chunk long, packed binary, times binary")
        .groupBy("bucket").applyInArrow(_shared(hot_rows), "bucket long, chunk long, packed binary, salts binary"),
        "bits",
    ).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "packed", "salts")).alias("bits"))
    asked = chunks.join(bits, "chunk", "left")
    found = written(
        asked.mapInArrow(_send_contexts(buckets, span), "route long, chunk long, first long, rows binary, ids binary").groupBy("route")
        .applyInArrow(_resolve(span), RESOLVED),
        "masks",
    )
    masks = found.where("packed is not null").groupBy("chunk").agg(F.collect_list(F.struct("route", "packed")).alias("masks"))
    salted = found.where("contexts is not null").drop("chunk", "packed")
    met = (
        salted.mapInArrow(_send_window_fingerprints(buckets, span), "part long, route long, packed binary")
        .groupBy("part").applyInArrow(_met, "part long, route long, packed binary")
        .groupBy("route").agg(F.collect_list(F.struct("part", "packed")).alias("met"))
    )
    late = (
        salted.join(met, "route")
        .mapInArrow(_send_windows(buckets, span), "part long, windows binary, ids binary, origins binary, entries binary, places binary")
        .groupBy("part").applyInArrow(_least(span), "chunk long, entries binary, bits binary")
        .groupBy("chunk").agg(F.collect_list(F.struct("entries", "bits")).alias("late"))
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text]
    schema = ", ".join([
        *fields, "n_bytes long", "n_removed long", "n_spans long", "kept_sha256 string", "spans array<struct<start:long,stop:long>>", "kept binary",
    ])
    return asked.join(masks, "chunk", "left").join(late, "chunk", "left").mapInArrow(_mark(buckets, span, keep, names), schema)


def repeated_passages(
    docs: DataFrame, span: int = SPAN, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, with_kept: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mark the bytes that are covered by a `span`-byte string that also starts in a document with a smaller id.

    docs: doc_id long, text; other columns are ignored. Returns one row per input row: doc_id, n_bytes, n_removed,
    n_spans (maximal removed runs), kept_sha256, spans (start, stop within the document's bytes) and, if asked for, kept (the
    bytes that stay). Null texts are empty; texts shorter than `span` lose nothing. A null id comes after all others
    and rows with equal ids (so also with null ids) do not remove each other's bytes. An empty table gives no rows.
    span: 17 to 79 bytes. hot_rows: a gram that stands more often is dealt over salts of about so many contexts.
    """
    if not GRAM < span < 80:
        raise ValueError("span must be from 17 to 79")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text_"))
    out = _resolved(source, "text_", span, chunk_bytes, bucket_bytes, hot_rows, "bytes" if with_kept else None)
    return out if with_kept else out.drop("kept")


def drop_repeated_passages(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """`docs` with the repeated passages cut out of `text`, and n_chars brought up to date; all rows and columns stay.

    A character goes only with all its bytes. A text that is repeated throughout becomes empty. `docs` may have columns
    of any name but text_, kept, spans, n_bytes, n_removed, n_spans and kept_sha256.
    """
    source = docs.withColumn("text_", text_bytes()).withColumn("doc_id", F.col("doc_id").cast("long")).drop("text")
    found = _resolved(source, "text_", span, CHUNK_BYTES, BUCKET_BYTES, HOT_ROWS, "characters")
    text = F.col("kept").cast("string")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))
