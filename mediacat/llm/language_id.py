"""Language identification by interpolated Kneser-Ney character models, one per language.

Texts are read as letters and single blanks. The n-grams of all languages are kept together: for each order a sorted
array of 64-bit hashes with one column of log probabilities per language, and one of the contexts' interpolation weights. A
character is looked up at the highest order first and falls back through its contexts' weights. The language with the
lowest cross-entropy per character wins; a text that its winner explains worse than nearly all of that
language's own texts is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediacat.llm.common import held_out, slices, text_bytes

ORDER = 4
SAMPLE_DOCS = 600
"""Documents per language that the models and the rejection bound are fitted on, chosen by a hash of their ids."""
SAMPLE_CHARS = 20_000
"""Characters that a sampled document gives: all, or of a longer one `PIECES` pieces from all over it; every text is scored whole."""
PIECES = 20
MAX_LANGUAGES = 256
REJECT_QUANTILE = 0.995
UNDETERMINED = "und"
START, BLANK = 1, 32

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def read_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all texts, each after ORDER - 1 start marks, the texts' offsets, and whether a text has a letter."""
    head = chr(START) * (ORDER - 1)
    parts = [head + t.lower().replace(chr(START), " ") for t in texts]
    points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    letter, start = letters()[points], points == START
    keep = letter | start
    keep[1:] |= letter[:-1]  # one blank after a letter, whatever stands there
    kept = np.concatenate(([0], np.cumsum(keep)))
    has = np.concatenate(([0], np.cumsum(letter)))
    out = np.where(letter | start, points, BLANK)[keep]
    return out, kept[ends], np.diff(has[ends]) > 0


def gram_hashes(points: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each character, for n = 0 to ORDER."""
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    out = [np.zeros(len(points), np.uint64)]
    shifted = x
    for n in range(1, ORDER + 1):
        out.append(out[-1] * np.uint64(0xBF58476D1CE4E5B9) + shifted if n == 1 else out[-1] + shifted * np.uint64(pow(0xBF58476D1CE4E5B9, n - 1, 1 << 64)))
        shifted = np.concatenate((np.zeros(1, np.uint64), shifted[:-1]))
    return [o ^ (o >> np.uint64(31)) if n else o for n, o in enumerate(out)]


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(keys, return_index=True, return_counts=True)


def fit_language(points: np.ndarray, scored: np.ndarray, uniform: float) -> tuple[list, list]:
    """For each order: (n-grams, probabilities, suffixes, contexts) and (contexts, interpolation weights)."""
    grams = gram_hashes(points)
    before = [np.concatenate((np.zeros(1, np.uint64), g[:-1])) for g in grams]
    at = np.flatnonzero(scored)
    of_order: list = [None] * (ORDER + 1)
    weights: list = [None] * (ORDER + 1)
    last_keys, last_p = None, None
    spots = {}
    for n in range(ORDER, 0, -1):
        keys, first, count = _counts(grams[n][at])
        spots[n] = (keys, at[first], count)
    for n in range(1, ORDER + 1):
        keys, spot, count = spots[n]
        if n < ORDER:  # continuation counts: in how many (n + 1)-grams
            longer = grams[n][spots[n + 1][1]]
            found, count = np.unique(longer, return_counts=True)
            assert len(found) == len(keys)
        contexts = before[n - 1][spot]
        ctx, inverse = np.unique(contexts, return_inverse=True)
        total = np.bincount(inverse, weights=count)
        kinds = np.bincount(inverse)
        once, twice = (count == 1).sum(), (count == 2).sum()
        discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
        weight = discount * kinds / total
        lower = np.full(len(keys), uniform) if n == 1 else last_p[np.searchsorted(last_keys, grams[n - 1][spot])]
        p = np.maximum(count - discount, 0) / total[inverse] + weight[inverse] * lower
        of_order[n] = (keys, p, grams[n - 1][spot], contexts)
        weights[n] = (ctx, weight)
        last_keys, last_p = keys, p
    return of_order, weights


def join_models(models: list[tuple[list, list]], uniform: float) -> dict:
    """Sorted hash arrays over all languages, with one column for each."""
    tables, weight_tables = [], []
    last_keys, last = None, None
    for n in range(1, ORDER + 1):
        ctx = np.unique(np.concatenate([m[1][n][0] for m in models]))
        logw = np.zeros((len(ctx), len(models)), np.float32)
        for i, (_, weights) in enumerate(models):
            logw[np.searchsorted(ctx, weights[n][0]), i] = np.log(weights[n][1])
        keys, spot = np.unique(np.concatenate([m[0][n][0] for m in models]), return_index=True)
        suffix = np.concatenate([m[0][n][2] for m in models])[spot]
        context = np.concatenate([m[0][n][3] for m in models])[spot]
        lower = np.full((len(keys), len(models)), np.log(uniform), np.float32) if n == 1 else last[np.searchsorted(last_keys, suffix)]
        logp = logw[np.searchsorted(ctx, context)] + lower
        for i, (grams, _) in enumerate(models):
            logp[np.searchsorted(keys, grams[n][0]), i] = np.log(grams[n][1])
        tables.append((keys, logp.astype(np.float32)))
        weight_tables.append((ctx, logw))
        last_keys, last = keys, logp
    return {"grams": tables, "weights": weight_tables, "uniform": float(np.log(uniform))}


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted


def entropies(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text under each language, the characters counted, and whether there is a letter."""
    points, ends, has = read_texts(texts)
    width = model["grams"][0][1].shape[1]
    scored = points != START
    grams = gram_hashes(points)
    at = np.flatnonzero(scored)
    distinct, first, inverse = np.unique(grams[ORDER][at], return_index=True, return_inverse=True)  # each n-gram is looked up once a block
    spot = at[first]
    value = np.zeros((len(distinct), width), np.float32)
    open_ = np.arange(len(distinct))
    for n in range(ORDER, 0, -1):
        keys, logp = model["grams"][n - 1]
        row, hit = _find(keys, grams[n][spot[open_]])
        value[open_[hit]] += logp[row[hit]]
        open_ = open_[~hit]
        if not len(open_):
            break
        ctx, logw = model["weights"][n - 1]
        row, hit = _find(ctx, grams[n - 1][spot[open_] - 1] if n > 1 else np.zeros(len(open_), np.uint64))
        value[open_[hit]] += logw[row[hit]]
    value[open_] += model["uniform"]
    text_of = np.repeat(np.arange(len(texts)), np.diff(ends))[scored]
    count = np.bincount(text_of, minlength=len(texts))
    out = np.empty((len(texts), width))
    for i in range(width):
        out[:, i] = -np.bincount(text_of, weights=value[inverse, i], minlength=len(texts)) / np.maximum(count, 1)
    return out, count, has


def fit(samples: dict[str, list[str]]) -> dict | None:
    """Models of all languages; every third text of a language sets its rejection bound and is not counted (unless it is the only one)."""
    names = sorted(n for n, texts in samples.items() if any(c.isalpha() for t in texts for c in t))
    if not names:
        return None
    counted = {n: [t for i, t in enumerate(samples[n]) if i % 3 != 2 or len(samples[n]) < 3] for n in names}
    read = {n: read_texts(counted[n])[0] for n in names}
    uniform = 1.0 / (len(np.unique(np.concatenate(list(read.values())))) + 1)
    model = join_models([fit_language(read[n], read[n] != START, uniform) for n in names], uniform)
    bounds = []
    for i, n in enumerate(names):
        rest = [t for j, t in enumerate(samples[n]) if j % 3 == 2] or samples[n]
        loss, _, has = entropies(model, rest)
        bounds.append(float(np.quantile(loss[has, i], REJECT_QUANTILE)) * 1.05 if has.any() else float("inf"))
    return {**model, "names": names, "bounds": np.array(bounds)}


def sampled_text() -> Column:
    """`text`, or of one over `SAMPLE_CHARS` characters `PIECES` pieces of that much in all, parted by blanks.

    The text is cut into equal stretches, and a hash of id and stretch tells where in it the piece begins.
    """
    size = SAMPLE_CHARS // PIECES
    stretch = f"(length(text) div {PIECES})"
    begin = f"CAST(i * {stretch} + pmod(xxhash64(doc_id, i), {stretch} - {size} + 1) + 1 AS int)"
    pieces = F.expr(f"concat_ws(' ', transform(sequence(0, {PIECES - 1}), i -> substring(text, {begin}, {size})))")
    return F.when(F.length("text") <= SAMPLE_CHARS, F.col("text")).otherwise(pieces)


def train(docs: DataFrame) -> dict | None:
    """Fit on a bounded sample of the documents with a language that are not held out.

    A document of any length is taken if the hash of its id lies in the share that leaves `SAMPLE_DOCS` of its language, so
    the only thing that is gathered by language is a count. A long one gives pieces (`sampled_text`), so a language has
    about `SAMPLE_DOCS` times `SAMPLE_CHARS` characters at most.
    """
    parts = 1 << 20
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & (F.length("text") > 0))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return None
    share = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], min(parts, -(-parts * SAMPLE_DOCS // r["count"])))))
    rows = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share[F.col("lang")]).select("doc_id", "lang", sampled_text().alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["doc_id"], r["text"])):
        held = samples.setdefault(row["lang"], [])
        if len(held) < 2 * SAMPLE_DOCS:
            held.append(row["text"])
    return fit(samples)


def _identify(shared: object) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in slices(batches, "text", 1 << 20):
            texts = [t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
            names, scores, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [True] * len(texts)
            if model:
                loss, count, has = entropies(model, texts)
                best = loss.argmin(axis=1)
                shares = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * np.minimum(count, 200)[:, None])
                scores = np.where(has, np.round(1 / shares.sum(axis=1), 6), 0.0)
                names = [model["names"][b] if h else UNDETERMINED for b, h in zip(best, has)]
                rejected = ~has | (loss[np.arange(len(texts)), best] > model["bounds"][best])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return run


def identify(docs: DataFrame) -> DataFrame:
    """Predict the language of all documents with models fitted on those that have one and are not held out.

    docs: doc_id, text, lang; other columns are ignored. Returns one row per input row: doc_id, held_out, lang_pred, score (the
    winner's share of the likelihoods of at most 200 average characters), rejected (no letter, or a cross-entropy
    above the language's bound). Texts that are null, empty or without a letter are `und` with score 0, and so is every
    text if no language was learned; equal entropies go to the first language by name. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))  # bounded by the sample: ORDER entries per character of it
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_bytes().alias("text"))
    return source.mapInArrow(_identify(shared), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
