"""Quality, language and tokens: held-out accuracy, brute force, round trips."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from mediacat.llm import bpe_duckdb, language_id, quality_crf
from tests.llm import util

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1


# quality


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, links, ends = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), np.array([0, 4, 4, 5, 9])
    marginals, pairs, total = quality_crf.forward_backward(scores, links, ends)
    want, want_pairs, want_total = np.zeros((9, 2)), np.zeros((2, 2)), 0.0
    for a, b in zip(ends, ends[1:]):
        if a == b:
            continue
        weight = {}
        for states in itertools.product((0, 1), repeat=b - a):
            s = sum(scores[a + i, y] for i, y in enumerate(states)) + sum(links[x, y] for x, y in zip(states, states[1:]))
            weight[states] = np.exp(s)
        z = sum(weight.values())
        want_total += np.log(z)
        for states, w in weight.items():
            for i, y in enumerate(states):
                want[a + i, y] += w / z
            for x, y in zip(states, states[1:]):
                want_pairs[x, y] += w / z
    assert np.allclose(marginals, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_quality_of_held_out_documents(spark, docs, labels):
    got = {r["doc_id"]: r for r in quality_crf.classify(docs, labels).collect()}
    assert all(r["held_out"] == is_held_out(i) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for i, r in got.items())
    known = [(r["quality"], got[r["doc_id"]]) for r in labels.collect()]
    right = [q == g["predicted"] for q, g in known if g["held_out"]]
    assert len(right) > 50 and sum(right) / len(right) > 0.97


def test_scores_do_not_see_other_columns(spark, docs, labels):
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    one = {(r["doc_id"], r["score"]) for r in quality_crf.classify(docs, labels).collect()}
    assert one == {(r["doc_id"], r["score"]) for r in quality_crf.classify(other, labels).collect()}
    unseen = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert one == {(r["doc_id"], r["score"]) for r in quality_crf.classify(docs, unseen).collect()}


def test_quality_of_odd_documents(spark, labels):
    odd = util.odd_documents(spark)
    rows = quality_crf.classify(util.clashing(odd), labels.limit(0)).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.5}
    texts = spark.createDataFrame([(i, f"Good words come in whole sentences, number {i}.") for i in range(40)] + [(i, "%%% ### $$$ " * 9) for i in range(40, 80)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 40)) for i in range(80)] + [(None, 1), (3, None)], "doc_id long, quality int")
    both = texts.unionByName(odd.select((odd.doc_id + 1000).alias("doc_id"), "text"))
    rows = quality_crf.classify(both, marks).collect()
    assert all(r["predicted"] == int(r["doc_id"] < 40) for r in rows if r["doc_id"] is not None and r["doc_id"] < 80)
    assert all(r["score"] == quality_crf.EMPTY_SCORE for r in rows if r["doc_id"] in (1001, 1002, 1003))
    assert quality_crf.classify(texts.limit(0), marks).collect() == []
    kept = quality_crf.keep_good(util.clashing(util.documents(spark, [(1, None), (2, "Good words come in whole sentences.")])).drop("score"), labels.limit(0))
    assert kept.count() == 2 and "keep_id" in kept.columns


def test_sampled_runs_have_their_true_neighbours():
    for n in (0, 1, quality_crf.SAMPLE_LINES, quality_crf.SAMPLE_LINES + 1, 5000):
        runs = quality_crf.sample_runs(n, 7)
        assert sum(b - a for a, b in runs) == min(n, quality_crf.SAMPLE_LINES)
        assert all(b <= c for (_, b), (c, _) in zip(runs, runs[1:])) and all(0 <= a < b <= n for a, b in runs)
    text = "\n".join(f"Line {i} of many" + " and more" * (i % 7) + "!" * (i % 3) for i in range(1000))
    rows, _, ends = quality_crf.line_features(pa.array([text.encode()]))
    whole = quality_crf.with_neighbours(rows, ends)
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array([1], pa.int32()), pa.array([text.encode()], pa.binary())], names=["doc_id", "quality", "text"])
    found = [r for part in quality_crf._sample_features([batch]) for r in part.to_pylist()]
    assert len(found) == quality_crf.SAMPLE_RUNS and found[-1]["start"] > 800
    for r in found:
        part = quality_crf.run_features(np.frombuffer(r["rows"], np.float32).reshape(-1, quality_crf.N_FEATURES), r["lead"], r["trail"])
        assert np.array_equal(part, whole[r["start"] : r["start"] + len(part)])


def test_lines_far_down_are_learned(spark):
    """Long documents that differ only behind their first 128 lines, and short ones that do not tell."""
    same = "\n".join(f"The same plain opening stands here, line {i}." for i in range(150))
    good = same + "\n" + "\n".join(f"Then whole sentences follow in good order, number {i}." for i in range(600))
    bad = same + "\n" + "\n".join(f"%%% ### $$$ {i} | | |" for i in range(600))
    docs = spark.createDataFrame([(i, good if i % 2 else bad) for i in range(60)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert all(r["predicted"] == r["doc_id"] % 2 for r in quality_crf.classify(docs, marks).collect())


def test_line_features_of_nothing():
    rows, size, ends = quality_crf.line_features(pa.array([b"", None, b"\n \n"], pa.binary()))
    assert len(rows) == 0 and len(size) == 0 and ends.tolist() == [0, 0, 0, 0]


# language


def slow_probabilities(text_points, grams):
    """Interpolated Kneser-Ney by its definition. Returns p(context, character)."""
    order = language_id.ORDER
    counts = [dict() for _ in range(order + 1)]
    for i, c in enumerate(text_points):
        if c != language_id.START:
            gram = tuple(text_points[i - order + 1 : i + 1])
            counts[order][gram] = counts[order].get(gram, 0) + 1
    for n in range(order - 1, 0, -1):
        for gram in counts[n + 1]:
            counts[n][gram[1:]] = counts[n].get(gram[1:], 0) + 1
    discount = []
    for n in range(order + 1):
        once, twice = (sum(1 for v in counts[n].values() if v == k) for k in (1, 2))
        discount.append(min(0.95, max(0.1, once / max(1, once + 2 * twice))))

    def p(context, c):
        n = len(context) + 1
        lower = grams if n == 1 else p(context[1:], c)
        follow = {g: v for g, v in counts[n].items() if g[:-1] == context}
        if not follow:
            return lower
        total = sum(follow.values())
        return max(follow.get((*context, c), 0) - discount[n], 0) / total + discount[n] * len(follow) / total * lower

    return p


def test_entropy_equals_definition():
    texts = {"aa": ["abra kadabra abba", "barba abra 12 kad"], "bb": ["xyzzy yyx abra", "zzyx xyz"]}
    names = sorted(texts)
    read = {n: language_id.read_texts(texts[n])[0] for n in names}
    uniform = 1 / (len(np.unique(np.concatenate(list(read.values())))) + 1)
    model = language_id.join_models([language_id.fit_language(read[n], read[n] != language_id.START, uniform) for n in names], uniform)
    asked = ["abra xyz", "Abba, QUX! kad", "zz"]
    loss, count, _ = language_id.entropies(model, asked)
    for i, n in enumerate(names):
        p = slow_probabilities(read[n].tolist(), uniform)
        for j, text in enumerate(asked):
            points = language_id.read_texts([text])[0].tolist()
            logs = [np.log(p(tuple(points[k - language_id.ORDER + 1 : k]), points[k])) for k in range(len(points)) if points[k] != language_id.START]
            assert count[j] == len(logs) and np.isclose(loss[j, i], -np.mean(logs), rtol=1e-4)


def test_language_of_held_out_documents(spark, docs):
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    rows = [(r["lang"], got[r["doc_id"]]) for r in docs.collect()]
    held = [(a, g) for a, g in rows if g["held_out"]]
    assert sum(a == g["lang_pred"] for a, g in held) / len(held) > 0.97
    assert all(0 <= g["score"] <= 1 for _, g in held) and sum(g["rejected"] for _, g in held) < 0.05 * len(held)


def test_languages_of_long_documents_only(spark):
    """Every document of xx is longer than what a document gives to the sample; yy has short ones and one long one."""
    rng = random.Random(5)

    def words(letters, n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))

    rows = [(i, words("abcdefg", 8_000), "xx", "s", 0) for i in range(30)] + [(i, words("nopqrst", 200), "yy", "s", 0) for i in range(100, 130)]
    assert min(len(r[1]) for r in rows[:30]) > language_id.SAMPLE_CHARS
    df = spark.createDataFrame(rows, util.SCHEMA)
    assert language_id.train(df)["names"] == ["xx", "yy"]
    got = {r["doc_id"]: r for r in language_id.identify(df).collect()}
    assert all(got[r[0]]["lang_pred"] == r[2] for r in rows) and sum(r["rejected"] for r in got.values()) <= 3


def test_sample_of_a_long_text(spark):
    """Pieces from all over the text, each in its own stretch; characters beyond 16 bits count as one."""
    long = "".join(chr(0x10000 + i) for i in range(50_007))
    edge = "e" * language_id.SAMPLE_CHARS
    rows = [(1, long), (2, edge), (3, edge + "f"), (4, "short"), (5, long)]
    got = {r["doc_id"]: r["text"] for r in util.documents(spark, rows).select("doc_id", language_id.sampled_text().alias("text")).collect()}
    assert got[2] == edge and got[4] == "short" and len(got[3]) == language_id.SAMPLE_CHARS + language_id.PIECES - 1
    stretch = len(long) // language_id.PIECES
    for i, piece in enumerate(got[1].split(" ")):
        start = ord(piece[0]) - 0x10000
        assert piece == long[start : start + language_id.SAMPLE_CHARS // language_id.PIECES] and i * stretch <= start and start + len(piece) <= (i + 1) * stretch
    assert i == language_id.PIECES - 1 and got[1] != got[5]


def test_odd_languages(spark, docs):
    odd = util.odd_documents(spark)
    rows = language_id.identify(util.clashing(docs.unionByName(odd.withColumn("doc_id", odd.doc_id + 10**6)))).where("doc_id >= 1000000 or doc_id is null").collect()
    assert len(rows) == odd.count()
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (10**6 + 1, 10**6 + 2, 10**6 + 3, 10**6 + 15)} == {"und"}
    assert all(r["lang_pred"] != "und" for r in rows if r["doc_id"] in (10**6 + 4, 10**6 + 9))
    assert {r["lang_pred"] for r in language_id.identify(odd.where("doc_id < 0").unionByName(odd).withColumn("lang", odd.lang.substr(9, 9)).limit(3)).collect()} <= {"und", ""}
    assert language_id.identify(docs.limit(0)).collect() == []


# tokens


@pytest.fixture(scope="module")
def words():
    with open(public_tokenizers.path(bpe_duckdb.RANKS), "rb") as file:
        return bpe_duckdb.Words(bpe_duckdb.read_ranks(file.read()))


def test_encoding_equals_the_library(words):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})
    rnd = random.Random(1)
    pieces = [*"abstrvelmdABC'' \n\t  019 .,!?éßñ中文字  \x85\x1c😀٣", "'s", "'re", "'ll", "'ve", " '", " 's", "''", "<|endoftext|>"]
    texts = ["", " ", "\n", "'", "a" * 1000, "ab" * 2000, "".join(rnd.choice("abcdefgh") for _ in range(3000)), " " * 5000 + "a", "中" * 900]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    texts += ["".join(chr(c) for c in (rnd.randrange(0x110000) for _ in range(30)) if not 0xD800 <= c < 0xE000) for _ in range(100)]
    for text, (coded, plain) in zip(texts, bpe_duckdb.encode_block(words, texts)):
        assert np.frombuffer(coded, "<u4").tolist() == library.encode_ordinary(text) and plain == text.encode()


def test_words_that_share_a_hash(words, monkeypatch):
    monkeypatch.setattr(bpe_duckdb, "word_hashes", lambda points, starts: np.full(len(starts), 5, np.uint64))
    words.clear()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})
    texts = ["one two three", "four five"]
    for text, (coded, plain) in zip(texts, bpe_duckdb.encode_block(words, texts)):
        assert np.frombuffer(coded, "<u4").tolist() == library.encode_ordinary(text) and plain == text.encode()
    words.clear()


def test_words_are_forgotten_and_met_again(words, monkeypatch):
    """Ages of 20 words: the older half is taken over when met again, else worked out anew."""
    monkeypatch.setattr(bpe_duckdb, "KNOWN_WORDS", 40)
    words.clear()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})
    learnt = []
    monkeypatch.setattr(words, "learn", lambda hashes, new, learn=words.learn: (learnt.extend(new), learn(hashes, new))[1])
    for k in (0, 5, 10, 15, 20, 25, 100, 10, 10):
        text = " ".join(f"wörd{i}" for i in range(k, k + 25))
        (coded, plain), = bpe_duckdb.encode_block(words, [text])
        assert np.frombuffer(coded, "<u4").tolist() == library.encode_ordinary(text) and plain == text.encode()
    assert len(words.known) <= 80 and learnt.count(" wörd".encode()) < 9
    words.clear()


def test_documents_round_trip(spark, docs, words):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})
    odd = util.odd_documents(spark)
    df = docs.limit(60).unionByName(odd.withColumn("doc_id", odd.doc_id + 10**6))
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    rows = bpe_duckdb.encode_documents(util.clashing(df), with_ids=True).where("doc_id is not null").collect()
    assert len(rows) == df.where("doc_id is not null").count()
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and bytes(r["decoded"]) == texts[r["doc_id"]].encode()
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
    assert bpe_duckdb.encode_documents(df.limit(0)).collect() == []
