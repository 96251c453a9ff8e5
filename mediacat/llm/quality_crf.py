"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. Its features come from its own characters and words and from both neighbouring lines; the
chain's transitions tie neighbours together. Forward-backward marginals of the lines, weighted by their lengths, give
the document's score. Lines are trained with the label of their document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import flat, held_out, slices, text_bytes

SAMPLE_PER_CLASS = 2000
"""Labelled documents of each class that the model is fitted on, taken in the order of a hash of their ids."""
SAMPLE_LINES = 128
"""Lines of a sampled document that training takes: all up to here, else `SAMPLE_RUNS` runs from all over it; scoring takes all."""
SAMPLE_RUNS = 8
ROUNDS = 250
EMPTY_SCORE = 0.0

# Classes of bytes: 0 other ASCII symbols, then upper, lower, digit, blank, sentence marks, quotes and brackets, "!", "|", beyond ASCII.
KINDS = np.zeros(256, np.int64)
for _kind, _chars in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b".,;:?", b"'\"()-", b"!", b"|"), start=1
):
    KINDS[list(_chars)] = _kind
KINDS[128:] = 9
N_KINDS = 10
N_FEATURES = 19


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all non-blank lines, their lengths in bytes, and the offsets of the documents' lines."""
    data, offsets = flat(texts)
    rows, lengths, ends, words_of, new_of, first_of, last_of, twice_of, before_of = [], [], [0], [], [], [], [], [], []
    starts: list[int] = []
    view = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        lines, at = [], a
        for line in view[a:b].split(b"\n"):
            if line and not line.isspace():
                lines.append(line)
                starts.append(at)
            at += len(line) + 1
        counts = Counter(lines)
        previous = None
        for line in lines:
            words = line.split()
            words_of.append(len(words))
            new_of.append(len(set(words)))
            first_of.append(line.lstrip()[0])
            last_of.append(line.rstrip()[-1])
            twice_of.append(counts[line] > 1)
            before_of.append(line == previous)
            lengths.append(len(line))
            previous = line
        ends.append(len(lengths))
    n = len(lengths)
    size = np.array(lengths, np.int64)
    if not n:
        return np.zeros((0, N_FEATURES), np.float32), size, np.array(ends, np.int64)
    begin = np.array(starts, np.int64)
    counts = np.zeros((n, N_KINDS))
    kinds = KINDS[data]
    line_of = np.repeat(np.arange(n), size)
    inside = np.repeat(begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
    counts = np.bincount(line_of * N_KINDS + kinds[inside], minlength=n * N_KINDS).reshape(n, N_KINDS)
    words, fresh = np.array(words_of, np.float64), np.array(new_of, np.float64)
    letters = counts[:, 1] + counts[:, 2]
    first, last = KINDS[np.array(first_of)], np.array(last_of)
    rows = np.column_stack([
        counts[:, 0] / size * 4, counts[:, 1] / np.maximum(letters, 1), letters / size, counts[:, 3] / size, counts[:, 4] / size * 2,
        counts[:, 5] / size * 4, counts[:, 6] / size * 4, counts[:, 7] / size * 8, counts[:, 8] / size * 8, counts[:, 9] / size,
        np.log1p(size) / 5, np.log1p(words) / 4, np.minimum(size / np.maximum(words, 1), 30) / 10, fresh / np.maximum(words, 1),
        (first == 1), (last == ord(".")), np.array(twice_of), np.array(before_of), (words < 4),
    ])
    return rows.astype(np.float32), size, np.array(ends, np.int64)


def with_neighbours(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after (zero at the edges, with a flag), and a constant."""
    n = len(rows)
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    filled = ends[1:] > ends[:-1]
    heads, tails = ends[:-1][filled], ends[1:][filled] - 1
    before[heads], after[tails] = 0, 0
    edges = np.zeros((n, 2), np.float32)
    edges[heads, 0], edges[tails, 1] = 1, 1
    return np.hstack((rows, before, after, edges, np.ones((n, 1), np.float32)))


def _by_step(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents with lines, longest first, and their numbers of lines."""
    sizes = np.diff(ends)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    return order, sizes[order]


def forward_backward(scores: np.ndarray, links: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of the states [lines, 2], expected transitions [2, 2], and the sum of the log partition functions."""
    order, sizes = _by_step(ends)
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    heads = ends[:-1][order]
    steps = int(sizes[0]) if len(sizes) else 0
    alive = len(sizes) - np.searchsorted(sizes[::-1], np.arange(1, steps + 1))
    total = 0.0
    for t in range(steps):
        at = heads[: alive[t]] + t
        if t:
            last = forward[at - 1]
            forward[at] = scores[at] + np.logaddexp(last[:, :1] + links[0], last[:, 1:] + links[1])
        else:
            forward[at] = scores[at]
    tails = heads + sizes - 1
    partition = np.logaddexp(forward[tails, 0], forward[tails, 1]) if len(heads) else np.zeros(0)
    total = float(partition.sum())
    for t in range(steps - 2, -1, -1):
        at = heads[: alive[t + 1]] + t
        later = backward[at + 1] + scores[at + 1]
        backward[at] = np.logaddexp(links[:, 0] + later[:, :1], links[:, 1] + later[:, 1:])
    of_line = np.zeros(len(scores))
    of_line[np.concatenate([np.arange(h, h + s) for h, s in zip(heads, sizes)]) if len(heads) else []] = np.repeat(partition, sizes)
    marginals = np.exp(forward + backward - of_line[:, None])
    follows = np.ones(len(scores), bool)
    follows[heads] = False
    later = np.flatnonzero(follows)
    pairs = np.exp(
        forward[later - 1][:, :, None] + links[None] + (scores[later] + backward[later])[:, None, :] - of_line[later][:, None, None]
    )
    return marginals, pairs.sum(axis=0), total


def fit(features: np.ndarray, ends: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, penalty: float = 1e-4) -> dict:
    """Maximum likelihood with an L2 penalty; Adam over the whole sample. labels: one per document."""
    mean, spread = features.mean(axis=0), features.std(axis=0)
    constant = spread < 1e-9
    mean[constant], spread[constant] = 0.0, 1.0
    x = (features - mean) / spread
    y = np.repeat(labels, np.diff(ends))
    n, width = x.shape
    follows = np.ones(n, bool)
    follows[ends[:-1][np.diff(ends) > 0]] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[np.flatnonzero(follows) - 1], y[follows]), 1)
    weights = np.zeros(width + 4)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        scores = np.zeros((n, 2))
        scores[:, 1] = x @ weights[:width]
        links = weights[width:].reshape(2, 2)
        marginals, pairs, _ = forward_backward(scores, links, ends)
        gradient = np.concatenate((x.T @ (marginals[:, 1] - y), (pairs - seen).ravel())) / max(1, len(labels))
        gradient += penalty * weights
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return {"mean": mean, "spread": spread, "weights": weights[:width], "links": weights[width:].reshape(2, 2)}


def score(model: dict, texts: pa.Array) -> np.ndarray:
    """Length-weighted mean of the lines' marginals of being good; documents without a line get `EMPTY_SCORE`."""
    rows, size, ends = line_features(texts)
    scores = np.zeros((len(rows), 2))
    if len(rows):
        scores[:, 1] = ((with_neighbours(rows, ends) - model["mean"]) / model["spread"]) @ model["weights"]
    marginals, _, _ = forward_backward(scores, model["links"], ends)
    sums = np.concatenate(([0.0], np.cumsum(marginals[:, 1] * size)))
    lengths = np.concatenate(([0], np.cumsum(size)))
    total = lengths[ends[1:]] - lengths[ends[:-1]]
    out = np.full(len(total), EMPTY_SCORE)
    full = total > 0
    out[full] = (sums[ends[1:]] - sums[ends[:-1]])[full] / total[full]
    return np.round(np.clip(out, 0.0, 1.0), 6)


def sample_runs(lines: int, seed: int) -> list[tuple[int, int]]:
    """Runs of lines that training takes from a document: one from each of equal stretches, at a place chosen by the seed."""
    if lines <= SAMPLE_LINES:
        return [(0, lines)] if lines else []
    long = SAMPLE_LINES // SAMPLE_RUNS
    bounds = [lines * i // SAMPLE_RUNS for i in range(SAMPLE_RUNS + 1)]
    pick = np.random.default_rng(seed)
    starts = [a + int(pick.integers(0, b - a - long + 1)) for a, b in zip(bounds, bounds[1:])]
    return [(a, a + long) for a in starts]


def run_features(rows: np.ndarray, lead: int, trail: int) -> np.ndarray:
    """Features of a run with its neighbours; `rows` begins `lead` lines before the run and ends `trail` lines after it."""
    wide = with_neighbours(rows, np.array([0, len(rows)]))
    return wide[lead : len(rows) - trail]


def _sample_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", 2 << 20):
        rows, _, ends = line_features(part.column("text"))
        out = []
        for i, q, head, tail in zip(part.column("doc_id").to_pylist(), part.column("quality").to_pylist(), ends[:-1].tolist(), ends[1:].tolist()):
            for a, b in sample_runs(tail - head, i & 0xFFFFFFFF):
                low, high = max(head, head + a - 1), min(tail, head + b + 1)
                out.append((i, q, a, head + a - low, high - head - b, rows[low:high].tobytes()))
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        columns = list(zip(*out)) if out else [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "quality", "start", "lead", "trail", "rows"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> dict | None:
    """Fit on a bounded sample of the labelled documents that are not held out; None if a class is missing.

    labels: doc_id, quality (0, 1; null is unlabelled). Ids with both labels are left out.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("most"))
        .where("quality = most")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    one, two = (known.where(F.col("quality") == c).orderBy(*order).limit(per_class) for c in (0, 1))
    chosen = one.unionByName(two).select("doc_id", "quality")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    rows = (
        source.join(F.broadcast(chosen), "doc_id")  # two times per_class rows of two numbers
        .mapInArrow(_sample_features, "doc_id long, quality int, start long, lead int, trail int, rows binary").collect()
    )
    rows = sorted(tuple(r[:5]) + (bytes(r["rows"]),) for r in rows)
    if len({r[1] for r in rows}) < 2:
        return None
    parts = [run_features(np.frombuffer(blob, np.float32).reshape(-1, N_FEATURES), lead, trail) for *_, lead, trail, blob in rows]
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return fit(np.vstack(parts).astype(np.float64), ends, np.array([r[1] for r in rows]))


def _scored(model: dict | None) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text_", 2 << 20):
            texts = part.column("text_")
            found = score(model, texts) if model else np.full(part.num_rows, 0.5)
            names = [n for n in part.schema.names if n != "text_"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(found)], names=[*names, "score_"])

    return run


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score all documents with a model fitted on the labelled ones that are not held out.

    docs: doc_id, text; other columns are ignored. Returns one row per input row: doc_id, held_out, score (0 to 1, higher
    is better), predicted (1 if score >= 0.5). Null, empty and blank texts score `EMPTY_SCORE`; without labels
    of both classes every score is 0.5. Blank lines count for nothing. An empty table gives no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("text_"))
    return source.mapInArrow(_scored(train(docs, labels)), "doc_id long, held_out boolean, score_ double").select(
        "doc_id", "held_out", F.col("score_").alias("score"), (F.col("score_") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the classifier accepts, all columns, in the pass that scores them.

    `docs` may have columns of any other name than text_ and score_.
    """
    model = train(docs, labels)
    source = docs.withColumn("text_", text_bytes())
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return source.mapInArrow(_scored(model), ", ".join([*schema, "score_ double"])).where("score_ >= 0.5").drop("score_")
