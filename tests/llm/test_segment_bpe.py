"""BPE by segment trees against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from mediacat.llm import bpe_segment_tree
from tests.llm import util

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(bpe_segment_tree.VOCABULARY)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return bpe_segment_tree.Coder(file.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def encoded(coder, texts):
    out = []
    for found in coder.encode([t.encode() for t in texts]):
        ids = np.frombuffer(b"".join(i for i, _ in found), "<u4").tolist()
        out.append((ids, " ".join(p for _, p in found)))
    return out


def wanted(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def odd_texts():
    rnd = random.Random(3)
    pieces = [*"abstrvelmdABC'' \n\t  019 .,!?éßñ中文字  \x85\x1c😀٣ΣΆ̸́=\0", "'s", "'re", "'LL", "<|endoftext|>", "<|", "<|startoftext|>"]
    texts = ["", " ", "I'M it'll", "<|endoftext|>a<|startoftext|> b<|ENDOFTEXT|>", "ΑΣ ΣΑΣ. İI", "é = ≠", "\0 \0a\0", "ab" * 3000, "中" * 300]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    return texts + ["".join(chr(c) for c in (rnd.randrange(0x110000) for _ in range(30)) if not 0xD800 <= c < 0xE000) for _ in range(500)]


def test_encoding_equals_the_library(coder, library):
    texts = odd_texts()
    assert encoded(coder, texts) == [wanted(library, t) for t in texts]
    assert [encoded(coder, [t])[0] for t in texts[:300]] == [wanted(library, t) for t in texts[:300]]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 63, 64, 65, 66, 200])
def test_forests_and_single_trees_agree(coder, size):
    rnd = random.Random(size)
    words = ["".join(rnd.choices("etaoinshr", k=size)) for _ in range(200)] + ["a" * size]
    ids, ends = bpe_segment_tree.merge_forest(coder.vocabulary, words)
    singles = [bpe_segment_tree.merge_tree(coder.vocabulary, w) for w in words]
    assert np.array_equal(ids, np.concatenate(singles)) and ends.tolist() == np.cumsum([len(s) for s in singles]).tolist()


def test_words_are_forgotten_and_learnt_again(coder, library, monkeypatch):
    monkeypatch.setattr(bpe_segment_tree, "KNOWN_STRETCHES", 40)
    texts = [" ".join(f"word{i % 90}x{i % 7}" for i in range(k, k + 60)) for k in range(0, 600, 20)]
    assert [encoded(coder, [t])[0] for t in texts] == [wanted(library, t) for t in texts]


def test_long_texts_go_part_by_part(coder, library, monkeypatch):
    monkeypatch.setattr(bpe_segment_tree, "BLOCK_BYTES", 50)
    text = "Some words, and ever more; " * 40 + "x" * 300 + "   end "
    assert len(list(bpe_segment_tree.parts(text.encode(), 50))) > 10
    assert encoded(coder, [text]) == [wanted(library, text)]


def test_documents(spark, library):
    odd = util.odd_documents(spark)
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(80).unionByName(odd.withColumn("doc_id", odd.doc_id + 10**6))
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    rows = bpe_segment_tree.encode_documents(util.clashing(df), with_ids=True).collect()
    assert len(rows) == df.count() and sum(r["doc_id"] is None for r in rows) == 2
    for r in rows:
        if r["doc_id"] is not None:
            ids, plain = wanted(library, texts[r["doc_id"]])
            assert r["ids"] == ids and r["decoded"] == plain and r["n_tokens"] == len(ids)
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r["decoded_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
    assert bpe_segment_tree.encode_documents(df.limit(0)).collect() == []


def test_other_files_are_refused(spark):
    with pytest.raises(ValueError):
        bpe_segment_tree.encode_documents(util.odd_documents(spark), public_tokenizers.path("byte_bpe_50k.json"))
