"""From raw documents to packed training sequences: five stages, each a Parquet table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediacat.llm import exact_dedup, packing, quality_crf, simhash, suffix_dedup
from mediacat.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    return quality_crf.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.keep_one_of_each(docs)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id."""
    return simhash.keep_one_of_each_component(docs)


def passages_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id holds."""
    return suffix_dedup.drop_repeated_passages(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in the training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_once),
    ("SimHash near-dedup", near_once),
    ("suffix-array dedup", passages_once),
    ("best-fit packing", packed),
]

# A fitted classifier and a greedy packing are not SQL; tests/llm/test_others.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
