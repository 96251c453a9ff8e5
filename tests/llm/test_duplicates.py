"""Exact, near and passage duplicates against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
import zstandard

from mediacat.llm import exact_dedup, simhash, suffix_dedup
from mediacat.llm.common import components
from tests.llm import util

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# exact dedup


def exact_expected(rows):
    groups = {}
    for i, t in rows:
        b = (t or "").encode()
        groups.setdefault(b.translate(None, util.WHITE), []).append((-len(t or ""), i is None, i or 0, t or ""))
    out = []
    for i, t in rows:
        norm = (t or "").encode().translate(None, util.WHITE)
        best = min(groups[norm], key=lambda x: (*x[:3], xxhash.xxh64_intdigest(x[3].encode(), 42) - (1 << 63)))
        keep = None if best[1] else best[2]
        out.append((i, keep, len(groups[norm]), i == keep and -len(t or "") == best[0], hashlib.sha256(norm).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("hash_bits", "trie_bytes"), [(64, 32 << 20), (1, 32 << 20), (0, 1000)])
def test_exact_duplicates_equal_brute_force(spark, docs, hash_bits, trie_bytes):
    for df in (docs.select("doc_id", "text"), util.odd_documents(spark).select("doc_id", "text")):
        rows = [tuple(r) for r in df.collect()]
        got = exact_dedup.exact_duplicates(df.repartition(3), hash_bits, trie_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == exact_expected(rows)


def test_radix_trie_splits_and_spills():
    rnd = random.Random(3)
    keys = sorted({bytes(rnd.choice(b"ab") for _ in range(6)) for _ in range(60)} | {b"", b"a", b"ab"})
    trie, spilled, want = exact_dedup.RadixTrie(), [], {}
    for key in keys:
        for i in range(2):
            trie.insert(key, [len(key), i, 0, 1])
            want[key] = [len(key), 0, 0, 2]
        spilled += list(trie.spill(keep=key))  # sorted input: everything before the last key is finished
    spilled += list(trie.spill())
    assert dict(spilled) == want and len(spilled) == len(want)


def test_keep_one_of_each(spark):
    df = util.clashing(util.odd_documents(spark))
    kept = exact_dedup.keep_one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # blank texts: the one with the most code points; "same text": the longest; long and repeated texts once
    assert sorted(ids) == [3, 5, 7, 9, 11, 12, 13, 14, 15]


# SimHash


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(rb"[\x20\x09-\x0D]+", text.lower()) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    for text in ["", " ", "one", "a b c", "a b c d", "A b C d e f g a b c d", "ÄÖ ä ö ü ß x", "x " * 500]:
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text.encode())


def test_spark_hashes_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("the words of it")).alias("h")).first()
    assert row["h"] & (1 << 64) - 1 == simhash.fingerprint(b"the words of it")


def test_near_duplicates_equal_brute_force(spark, docs):
    for df in (docs, util.clashing(util.odd_documents(spark))):
        got = simhash.near_duplicates(df).collect()
        ids = [2**62 if r["doc_id"] is None else r["doc_id"] for r in got]
        want = util.components([int(r["fingerprint"], 16) for r in got], ids, 4)
        assert [r["component_id"] for r in got] == [None if w == 2**62 else w for w in want]
        texts = {r["doc_id"]: r["text"] for r in df.collect() if r["doc_id"] is not None}
        assert all(int(r["fingerprint"], 16) == slow_fingerprint((texts[r["doc_id"]] or "").encode()) for r in got if r["doc_id"] is not None)


@pytest.mark.parametrize("max_bits", [0, 1, 4, 7])
def test_tree_finds_all_links(spark, max_bits):
    """Random centres, clouds around them and a dense ball; small shards, so that boundaries are crossed."""
    rng = np.random.default_rng(max_bits)
    centres = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for c in centres for _ in range(6)]
    ball = [int(centres[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a in range(20) for b in range(20)]
    prints = np.unique(np.array([*near, *ball], np.uint64))
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, max_bits, shard_rows=64)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    ids = np.arange(len(prints))
    want = util.components(prints, ids, max_bits)
    signed = prints.view(np.int64)
    label = np.array([found.get(int(p), int(p)) for p in signed])
    assert len(np.unique(label)) == len(np.unique(want))
    assert all(len(np.unique(label[want == w])) == 1 for w in np.unique(want))


def test_components_of_a_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1000), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}


def test_keep_one_of_each_component(spark):
    df = util.odd_documents(spark)
    ids = [r["doc_id"] for r in simhash.keep_one_of_each_component(df).collect()]
    assert ids.count(4) == 1 and 6 not in ids and None not in ids and ids.count(1) == 1 and 2 not in ids


# passages


def check_passages(df, span, **sizes):
    rows = suffix_dedup.repeated_passages(df, span, with_kept=True, **sizes).collect()
    given = [(2**62 if r["doc_id"] is None else r["doc_id"], (r["text"] or "").encode()) for r in df.collect()]
    masks = util.removed([t for _, t in given], [i for i, _ in given], span)
    want = []
    for (i, t), m in zip(given, masks):
        edges = b"\0" + m + b"\0"
        starts = [k for k in range(len(m)) if edges[k] < edges[k + 1]]
        stops = [k for k in range(1, len(m) + 1) if edges[k] > edges[k + 1]]
        kept = bytes(x for x, y in zip(t, m) if not y)
        want.append((i, len(t), sum(m), len(starts), hashlib.sha256(kept).hexdigest(), list(zip(starts, stops)), kept))
    got = [
        (2**62 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
        for r in rows
    ]
    assert sorted(got) == sorted(want)


def test_passages_equal_brute_force(spark, docs):
    check_passages(docs, 50, chunk_bytes=60_000, bucket_bytes=60_000)
    check_passages(util.clashing(util.odd_documents(spark)), 50, chunk_bytes=5000, bucket_bytes=20_000)


@pytest.mark.parametrize("span", [17, 30, 79])
def test_passages_of_random_pieces(spark, span):
    rnd = random.Random(span)
    parts = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(5, 120))) for _ in range(12)]
    rows = [(rnd.randint(0, 80), "".join(rnd.choice(parts)[rnd.randint(0, 9) :] for _ in range(rnd.randint(1, 6)))) for _ in range(80)]
    check_passages(util.documents(spark, rows), span, chunk_bytes=2000, bucket_bytes=4000)


@pytest.mark.parametrize("hot_rows", [1, 7])
def test_hot_passages_are_dealt_over_salts(spark, docs, hot_rows):
    rnd = random.Random(hot_rows)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    passage = " ".join(word() for _ in range(40))
    short = passage[50:110]
    rows = [(i, f"{word()} {word()} {passage if i % 3 else short}{word()} {word() * rnd.randint(1, 9)}") for i in range(150)]
    rows += [(200, passage * 6), (200, passage), (201, passage), (None, "x" + passage), (12, short + short)]
    check_passages(util.documents(spark, rows), 50, chunk_bytes=1500, bucket_bytes=20_000, hot_rows=hot_rows)
    check_passages(util.documents(spark, rows[:60]), 20, chunk_bytes=1500, bucket_bytes=20_000, hot_rows=hot_rows)
    check_passages(docs.limit(150), 50, chunk_bytes=30_000, bucket_bytes=60_000, hot_rows=hot_rows)


def test_no_task_takes_a_hot_gram():
    """Contexts of one gram in very many chunks: every salt holds about as many as it may."""
    passage = np.frombuffer(bytes(random.Random(5).choices(range(97, 123), k=400)), np.uint8)
    hashes = np.unique(suffix_dedup.find_anchors(passage, np.array([0, 400]))[1])
    bucket = int(suffix_dedup._bucket(hashes, 8)[0])
    mine = hashes[suffix_dedup._bucket(hashes, 8) == bucket].astype(np.uint32)
    n = 5000
    table = pa.table({
        "bucket": [bucket] * n, "chunk": list(range(n)), "packed": pa.array([mine.tobytes()] * n, pa.binary()),
        "times": pa.array([np.ones(len(mine), np.uint32).tobytes()] * n, pa.binary()),
    })
    found = suffix_dedup._shared(100)((pa.scalar(bucket),), table)
    routes = {}
    for chunk, packed, salts in zip(*(found.column(c).to_pylist() for c in ("chunk", "packed", "salts"))):
        assert set(np.frombuffer(salts, np.uint32)) == {50}
        at = suffix_dedup.Contexts(passage, np.array([0, 400]), np.array([chunk]), {bucket: (packed, salts)}, 8, 50, chunk)
        for route in at.route.tolist():
            routes[route] = routes.get(route, 0) + 1
    assert len(routes) == 50 and max(routes.values()) < 160 * len(mine)


def test_open_windows_are_one_row_of_a_salt():
    """A gram among ever new words: a salt gives one row for each chunk and one for all its open windows, and sends bytes only of what met."""
    rnd = np.random.default_rng(8)
    passages = rnd.integers(97, 123, (200, 16), dtype=np.uint8)
    passage = passages[suffix_dedup._gram_ranks(passages).argmin()]  # windows name the gram of the least hash
    rows = rnd.integers(97, 123, (600, 86), dtype=np.uint8)
    rows[:, 34:50] = passage
    rows[:, 84:] = (34, 50)
    rows[300] = rows[7]  # the only context that both salts have

    def salt(number, part):
        table = pa.table({
            "chunk": [2 * number, 2 * number + 1], "first": [0, 0], "rows": [zstandard.compress(x.tobytes()) for x in (part[:100], part[100:])],
            "ids": [np.arange(a, b).tobytes() for a, b in ((300 * number, 300 * number + 100), (300 * number + 100, 300 * number + 300))],
        })
        return suffix_dedup._resolve(50)((pa.scalar(number + 1),), table)

    found = [salt(0, rows[:300]), salt(1, rows[300:])]
    assert [t.num_rows for t in found] == [3, 3]
    opened = [t.slice(2).to_batches()[0] for t in found]
    sent = pa.Table.from_batches([b for o in opened for b in suffix_dedup._send_window_fingerprints(4, 50)([o])])
    met = [suffix_dedup._met((pa.scalar(k),), sent.filter(pc.equal(sent["part"], k))) for k in range(4)]
    met = pa.concat_tables(met).to_pylist()
    late, windows = {}, 0
    asked = [o.append_column("met", pa.array([[m for m in met if m["route"] == k + 1]])) for k, o in enumerate(opened)]
    parts = pa.Table.from_batches([b for o in asked for b in suffix_dedup._send_windows(4, 50)([o])])
    for k in set(parts["part"].to_pylist()):
        part = parts.filter(pc.equal(parts["part"], k))
        windows += sum(len(b) for b in part["places"].to_pylist())
        for r in suffix_dedup._least(50)((pa.scalar(k),), part).to_pylist():
            for entry, bits in zip(np.frombuffer(r["entries"], np.int64), np.frombuffer(r["bits"], np.uint64)):
                late[r["chunk"], int(entry)] = late.get((r["chunk"], int(entry)), 0) | int(bits)
    assert set(late) == {(2, 0)} and windows == 2 * late[2, 0].bit_count() > 0


def test_multikey_quicksort():
    rnd = np.random.default_rng(3)
    for n, letters, width in [(0, 2, 3), (1, 2, 3), (2, 1, 2), (500, 3, 4), (3000, 2, 6), (3000, 1000, 2)]:
        words = rnd.integers(0, letters, (n, width)).astype(np.uint64) * np.uint64(1 << 62)
        for depth in {1, width}:
            order, fresh = suffix_dedup.multikey_quicksort(words, depth)
            texts = [tuple(words[i, :depth]) for i in order]
            assert texts == sorted(texts) and sorted(order.tolist()) == list(range(n))
            assert fresh.tolist() == [k == 0 or texts[k] != texts[k - 1] for k in range(n)]


def test_deep_shallow_sorts():
    rng = np.random.default_rng(5)
    rows = rng.integers(97, 99, (600, 50), dtype=np.uint8)
    rows[100:500, :40] = rows[0, :40]  # long common prefixes, for the blind tries
    rows[200:220] = rows[0]
    for shallow in (1, 2, 4, 7):
        order, common = suffix_dedup.deep_shallow(rows, shallow)
        texts = [rows[i].tobytes() for i in order]
        assert texts == sorted(texts)
        for a, b, c in zip(texts, texts[1:], common[1:]):
            assert c == next((k for k in range(50) if a[k] != b[k]), 50)


def test_whole_characters_stay():
    text = "aäb".encode()
    assert suffix_dedup.whole_characters(text, [{"start": 0, "stop": 2}]) == "äb".encode()
    assert suffix_dedup.whole_characters(text, [{"start": 2, "stop": 4}]) == "aä".encode()
    assert suffix_dedup.whole_characters(text, [{"start": 1, "stop": 3}]) == b"ab"


def test_dropping_passages_keeps_rows_and_columns(spark):
    passage = "The same long passage stands in many documents of this corpus, word for word. "
    rows = [(1, "One. " + passage), (2, "Two. " + passage + "end"), (3, None), (4, "Four")]
    got = {r["doc_id"]: r for r in suffix_dedup.drop_repeated_passages(util.documents(spark, rows)).collect()}
    assert got[1]["text"] == rows[0][1] and got[3]["text"] == "" and got[4]["text"] == "Four"
    assert passage[:60] not in got[2]["text"] and got[2]["text"].startswith("Two") and got[2]["n_chars"] == len(got[2]["text"])


@pytest.mark.parametrize(
    "operator", [exact_dedup.exact_duplicates, simhash.near_duplicates, suffix_dedup.repeated_passages, suffix_dedup.drop_repeated_passages,
                 exact_dedup.keep_one_of_each, simhash.keep_one_of_each_component]
)
def test_empty_table(spark, operator):
    assert operator(util.documents(spark, [])).collect() == []
