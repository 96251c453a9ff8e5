"""Periodic runs of words: suffix classes united in the order of falling common prefixes.

A run is a stretch of words with smallest period q that no neighbouring word extends. Suffixes of a text are sorted by
prefix doubling, and neighbours in that order are the edges of a tree, weighted by their longest common prefix (LCP). Kruskal's
rounds take the edges from the largest LCP down; a class is the ordered set of the positions whose suffixes share that
many words. When two classes are united, the positions that become neighbours have exactly this LCP. A pair (i, i + q) with
q <= LCP is a repeat with period q: it seeds the run that starts at i unless the words before both are equal, and then
the run's length is q + LCP. The start pair of every run with at least two periods is such a pair: a position between i and
i + q with the same LCP would make the run's period smaller than q.

Only LCPs of at least `least_common` words can give a run of the wanted length, so texts in which no stretch of that many words
recurs (by a hash, which can only name too many) are left out, and Kruskal's rounds end there. The smaller of two classes is
always inserted into the larger one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import slices, text_bytes

MIN_LENGTH = 24
MIN_PERIODS = 3
BLOCK_BYTES = 4 << 20
WHITE = re.compile(rb"[ \t-\r]")

Run = tuple[int, int, int]
"""start, length, period"""


def least_common(min_length: int, min_periods: int) -> int:
    """The smallest LCP that a wanted run can have: its length is q + LCP with q <= LCP / (min_periods - 1)."""
    return max(1, -(-min_length * (min_periods - 1) // min_periods))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def recurring(codes: np.ndarray, ends: np.ndarray, span: int) -> np.ndarray:
    """Numbers of the texts in which some stretch of `span` words seems to recur. ends: offsets of the texts in `codes`."""
    if len(codes) < span:
        return np.empty(0, np.int64)
    h, width = _mix(codes.astype(np.uint64) + np.uint64(1)), 1
    while width < span:
        step = min(width, span - width)
        h = _mix(h[:-step] * np.uint64(0x9E3779B97F4A7C15) + h[step:])
        width += step
    start = np.arange(len(h))
    text = np.searchsorted(ends, start, side="right") - 1
    whole = start + span <= ends[text + 1]
    h, text = h[whole], text[whole]
    key = h ^ _mix(text.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    again = key[order[1:]] == key[order[:-1]]
    return np.unique(text[order[1:][again]])


def suffix_order(codes: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; stop[i] is where the text of position i ends, and texts do not mix."""
    n = len(codes)
    rank = np.empty(n, np.int64)
    order = np.lexsort((codes, stop))
    new = np.ones(n, bool)
    new[1:] = (codes[order[1:]] != codes[order[:-1]]) | (stop[order[1:]] != stop[order[:-1]])
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    width = 1
    while True:
        sizes = np.diff(np.append(first, n))
        tied = np.repeat(sizes > 1, sizes)  # by place in the order
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        members = order[at]
        next_rank = np.where(members + width < stop[members], rank[np.minimum(members + width, n - 1)], -1)
        group = rank[members]
        by = np.lexsort((next_rank, group))
        members, group, next_rank = members[by], group[by], next_rank[by]
        order[at] = members
        new = np.ones(len(at), bool)
        new[1:] = (group[1:] != group[:-1]) | (next_rank[1:] != next_rank[:-1])
        heads = np.zeros(n, bool)
        heads[first] = True
        heads[at[new]] = True
        first = np.flatnonzero(heads)
        starts = np.flatnonzero(new)
        rank[members] = np.repeat(at[starts], np.diff(np.append(starts, len(at))))
        width *= 2


def common_prefixes(codes: np.ndarray, stop: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LCP of each suffix in the order with the one before it (of the same text, else 0), from left to right through the text."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    same = stop[order[1:]] == stop[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    out = np.zeros(n, np.int64)
    word, partner, end, lcp = memoryview(codes), memoryview(before), memoryview(np.ascontiguousarray(stop)), memoryview(out)
    length = 0
    for i in range(n):
        j = partner[i]
        if j < 0:
            length = 0
            continue
        limit = end[i] - (i if i > j else j)
        while length < limit and word[i + length] == word[j + length]:
            length += 1
        lcp[i] = length
        if length:
            length -= 1
    return out[order]


def unite(large: list[int], small: list[int]) -> Iterator[tuple[int, int]]:
    """Insert the ordered positions `small` into `large`; the pairs of neighbours that one of each makes."""
    for k in range(len(small) - 1, -1, -1):  # from the right, so what is right of a position is complete
        x = small[k]
        at = bisect_left(large, x)
        if at < len(large) and not (k + 1 < len(small) and small[k + 1] == large[at]):
            yield x, large[at]
        if at and not (k and small[k - 1] > large[at - 1]):
            yield large[at - 1], x
        large.insert(at, x)


def kruskal_runs(codes: np.ndarray, stop: np.ndarray, min_length: int, min_periods: int) -> list[Run]:
    """All runs of the texts that lie end to end in `codes`, by position in `codes`."""
    least = least_common(min_length, min_periods)
    order = suffix_order(codes, stop)
    lcp = common_prefixes(codes, stop, order)
    edges = np.flatnonzero(lcp >= least)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    left, right, weight = order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist()
    word, end = memoryview(codes), stop
    parent: dict[int, int] = {}
    places: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    found: list[Run] = []
    for a, b, common in zip(left, right, weight):
        for x in (a, b):
            if x not in parent:
                parent[x], places[x] = x, [x]
        a, b = root(a), root(b)
        if len(places[a]) < len(places[b]):
            a, b = b, a
        parent[b] = a
        for i, j in unite(places[a], places.pop(b)):
            period = j - i
            if period * (min_periods - 1) <= common and period + common >= min_length:
                if i == 0 or end[i - 1] != end[i] or word[i - 1] != word[j - 1]:
                    found.append((i, period + common, period))
    return found


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods; of equal ones the first, then the one with the smallest period."""
    best = None
    for run in runs:
        if best is None:
            best = run
            continue
        gain = run[1] * best[2] - best[1] * run[2]
        if gain > 0 or (gain == 0 and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """Cut a text at white space into parts of about `size` bytes."""
    at = 0
    while len(text) - at > size:
        gap = WHITE.search(text, at + size)
        if gap is None:
            break
        yield text[at : gap.start()]
        at = gap.end()
    yield text[at:] if at else text


def block_runs(texts: list[bytes], min_length: int, min_periods: int) -> list[tuple[int, list[Run], Run | None, bytes]]:
    """For each text its number of words, its runs, the strongest one, and the text with every run cut to its first period."""
    table: defaultdict[bytes, int] = defaultdict()
    table.default_factory = table.__len__
    number = table.__getitem__
    coded, ends = [], [0]
    for text in texts:
        mine = [np.fromiter(map(number, part.split()), np.int32) for part in parts(text, BLOCK_BYTES)]
        coded += mine
        ends.append(ends[-1] + sum(map(len, mine)))
    codes, edges = np.concatenate(coded) if coded else np.empty(0, np.int32), np.array(ends)
    chosen = recurring(codes, edges, least_common(min_length, min_periods))
    runs: dict[int, list[Run]] = {}
    if len(chosen):
        sizes = np.diff(edges)[chosen]
        own = np.concatenate([codes[edges[t] : edges[t + 1]] for t in chosen])
        stops = np.cumsum(sizes)
        for start, length, period in kruskal_runs(own, np.repeat(stops, sizes), min_length, min_periods):
            k = int(np.searchsorted(stops, start, side="right"))
            runs.setdefault(int(chosen[k]), []).append((start - int(stops[k] - sizes[k]), length, period))
    words = list(table) if runs else []
    out = []
    for t, text in enumerate(texts):
        mine = sorted(runs.get(t, ()), key=lambda run: (run[0], run[2]))
        if mine:
            change = np.zeros(ends[t + 1] - ends[t] + 1, np.int64)
            for start, length, period in mine:
                change[start + period] += 1
                change[start + length] -= 1
            kept = codes[edges[t] : edges[t + 1]][np.cumsum(change[:-1]) == 0]
            collapsed = b" ".join(map(words.__getitem__, kept.tolist()))
        else:
            collapsed = b" ".join(filter(None, (b" ".join(part.split()) for part in parts(text, BLOCK_BYTES))))
        out.append((ends[t + 1] - ends[t], mine, strongest(mine), collapsed))
    return out


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _found(min_length: int, min_periods: int) -> Callable:
    def row(run: Run) -> dict[str, int]:
        return dict(zip(("start", "length", "period"), run))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", BLOCK_BYTES):
            found = block_runs(part.column("text").to_pylist(), min_length, min_periods)
            columns = [
                part.column("doc_id"), pa.array([n for n, *_ in found], pa.int64()),
                pa.array([[row(r) for r in runs] for _, runs, *_ in found], pa.list_(RUN)),
                pa.array([row(best) if best else None for _, _, best, _ in found], RUN),
                pa.array([text for *_, text in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Stretches of words that repeat with a period, and the texts without the repeats.

    docs: doc_id, text; other columns are ignored. Words are the stretches between ASCII white space, numbered from 0. A run
    has smallest period q, at least `min_length` words and at least `min_periods` (2 or more) times q, and no neighbouring word extends it.
    Returns one row per input row: doc_id, n_words, runs (start, length, period; by start, then period), strongest (the run
    with the greatest length / period, ties to the smallest start, then period; null without runs) and collapsed (words joined by one
    space, without those that lie in a run behind its first q words). Null, empty and blank texts have no words
    and an empty `collapsed`; repeated rows each get their own row. An empty table gives no rows. A text is
    worked on whole in one task, with some 150 bytes of memory for each of its words if it repeats itself.
    """
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    run = "struct<start:long,length:long,period:long>"
    out = source.mapInArrow(_found(min_length, min_periods), f"doc_id long, n_words long, runs array<{run}>, strongest {run}, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document (by the CRC of its id) ends in a period of its own words.

    With h the CRC-32 of the decimal id and g = floor(h / 10): if h % 10 = 0 and there are n > 0 words, word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows without id keep their text.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text").cast("string"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")

    def changed(d: Column) -> Column:
        a, n = F.pmod(d["g"], d["n"]).cast("int"), d["n"]
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(d["g"], F.lit(8)))).cast("int")
        tail = F.slice(d["words"], a + 1, p)
        whole = F.floor((n - a) / p).cast("int")
        return F.concat(F.slice(d["words"], F.lit(1), a), F.flatten(F.array_repeat(tail, whole)), F.slice(tail, F.lit(1), n - a - whole * p))

    planted = F.when(h % 10 == 0, F.struct(words.alias("words"), F.size(words).alias("n"), F.floor(h / 10).alias("g")))
    text = F.when(F.col("planted.n") > 0, F.array_join(changed(F.col("planted")), " ")).otherwise(F.col("text").cast("string"))
    return docs.select("doc_id", "text", planted.alias("planted")).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run with floor(1000 * length / period), and hashes of all runs and of what stays."""
    run = F.col("strongest")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), run["start"].alias("start"), run["length"].alias("length"),
        run["period"].alias("period"), F.expr("strongest.length * 1000L div strongest.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
