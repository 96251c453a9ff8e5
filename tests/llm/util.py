"""Inputs and brute-force versions for the tests of the text operators."""

import numpy as np

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = b" \t\n\x0b\x0c\r"


def documents(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text); the other columns are filled."""
    if schema != SCHEMA:
        return spark.createDataFrame(rows, schema)
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA)


def odd_documents(spark):
    """Nulls, blanks, ties, repeated rows, long texts."""
    long = "word " * 3000 + "x" * 70_000
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "same text here today"), (5, "same  text here\ttoday"), (6, "same text here today"),
        (6, "same text here today"), (None, "same text here today"), (None, None), (7, long), (8, long), (9, "äöü 中文 😀 " * 40), (10, "äöü 中文 😀 " * 40),
        (11, "a"), (12, "aaaaaaaaaa" * 30), (13, "aaaaaaaaaa" * 29 + "b"), (14, "\x00\x01" * 40), (15, "!!!"),
    ]
    return documents(spark, rows)


def clashing(docs):
    """The same table with further columns that are named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("text_sha256", "keep_id", "fp", "fingerprint", "score", "predicted", "bin", "capacity", "chunk", "rows", "hash", "norm", "u", "v", "part", "held_out")
    return docs.select("*", *(F.lit("other").alias(n) for n in names))


def components(fingerprints, ids, max_bits):
    """Smallest id of each fingerprint's component, by comparing all."""
    prints = np.array(fingerprints, np.uint64)
    label = np.array(ids, np.int64)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= max_bits) for p in prints]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return new
        label = new


def removed(texts, ids, span):
    """For each text a mask of the bytes covered by a span that starts in a text with a smaller id."""
    first = {}
    for i, t in sorted(zip(ids, texts), key=lambda x: x[0]):
        for a in range(len(t) - span + 1):
            first.setdefault(t[a : a + span], i)
    out = []
    for i, t in zip(ids, texts):
        mask = bytearray(len(t))
        for a in range(len(t) - span + 1):
            if first[t[a : a + span]] < i:
                mask[a : a + span] = b"\1" * span
        out.append(bytes(mask))
    return out
