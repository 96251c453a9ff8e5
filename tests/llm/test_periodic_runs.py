"""Periodic runs against a search over all starts and periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from mediacat.llm import periodic_runs, queries
from tests.llm import util


def brute_runs(words, min_length, min_periods):
    n, found = len(words), set()
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            root = words[i : i + q]
            primitive = not any(q % d == 0 and root == root[:d] * (q // d) for d in range(1, q))
            if length >= max(min_length, min_periods * q) and primitive:
                found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute(words, min_length=24, min_periods=3):
    runs = brute_runs(words, min_length, min_periods)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs)]
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return len(words), runs, best, b" ".join(kept)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def random_texts(rnd, count):
    out = []
    for _ in range(count):
        words = []
        for _ in range(rnd.randint(0, 5)):
            root = rnd.choices([b"a", b"b", b"cc", b"d"], k=rnd.randint(1, 12))
            words += root * rnd.randint(1, 9) + root[: rnd.randint(0, len(root))]
        out.append(b" ".join(words))
    return out


@pytest.mark.parametrize("min_length, min_periods", [(24, 3), (5, 2), (1, 2), (9, 4)])
def test_runs_equal_brute_force(min_length, min_periods):
    texts = random_texts(random.Random(min_length), 150)
    texts += [b"", b" \n", b"a", b"a " * 400, b"a b " * 200, b"a a b " * 100, b" ".join([b"x", b"y"] * 30 + [b"z"] * 40 + [b"x", b"y"] * 30)]
    a, b = b"a", b"b"
    for _ in range(8):  # Fibonacci words hold very many runs
        a, b = a + b" " + b, a
    texts.append(a)
    assert periodic_runs.block_runs(texts, min_length, min_periods) == [brute(t.split(), min_length, min_periods) for t in texts]


def test_texts_of_many_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK_BYTES", 64)
    texts = random_texts(random.Random(8), 60)
    assert periodic_runs.block_runs(texts, 24, 3) == [brute(t.split()) for t in texts]


def test_suffix_order_and_common_prefixes():
    rng = np.random.default_rng(4)
    sizes = [40, 1, 70, 3]
    codes = rng.integers(0, 2, sum(sizes)).astype(np.int32)
    stop = np.repeat(np.cumsum(sizes), sizes)
    order = periodic_runs.suffix_order(codes, stop)
    suffix = [(int(stop[i]), codes[i : stop[i]].tolist()) for i in range(len(codes))]
    assert [suffix[i] for i in order] == sorted(suffix)
    lcp = periodic_runs.common_prefixes(codes, stop, order)
    for before, at, length in zip([None, *order], order, lcp):
        same = before is not None and stop[before] == stop[at]
        x, y = (suffix[before][1], suffix[at][1]) if same else ([], [])
        assert length == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))


def test_a_long_uniform_text():
    assert periodic_runs.block_runs([b"w " * 100_000], 24, 3)[0] == (100_000, [(0, 100_000, 1)], (0, 100_000, 1), b"w")


def test_query_equals_brute_force(spark, tmp_path):
    odd = util.odd_documents(spark)
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) < 1500").limit(150)
    repeats = util.documents(spark, [(10**6 + i, f"w{i} x y " * (8 + i % 9)) for i in range(40)])
    df = util.clashing(odd.unionByName(real).unionByName(repeats))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for r in df.collect():
        words = (r["text"] or "").encode().split()
        _, runs, best, kept = brute(planted(r["doc_id"], words) if r["doc_id"] is not None else words)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((
            r["doc_id"], len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
        ))
    key = str
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)
    assert sum(w[1] > 0 for w in want) > 50
    df.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert queries.op11_periodic_runs(spark, f"{tmp_path}/empty").collect() == []
