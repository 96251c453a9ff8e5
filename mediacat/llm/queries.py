"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacat.llm import (
    bpe_duckdb,
    bpe_segment_tree,
    exact_dedup,
    html_wrapper,
    language_id,
    packing,
    periodic_runs,
    preference,
    quality_crf,
    simhash,
    suffix_dedup,
    topk_search,
    whitening,
)
from mediacat.llm.common import table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_html_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract_articles(table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_duckdb.encode_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("spans")


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.preference_turns(*preference.swapped_endings(table(spark, sf_dir, "conversations")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_periodic_tails(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.periodic_runs(docs))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(whitening.whole_vectors(table(spark, sf_dir, "embeddings")))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op13_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_segment_tree.encode_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk_search, op2_simhash, op3_html_articles, op4_exact_dedup, op5_bpe, op6_quality, op7_language, op8_packing,
        op9_suffix_dedup, op10_preference, op11_periodic_runs, op12_whitening, op13_segment_bpe,
    )
}

SQL = {
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""",
    "op1_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
""",
    "op10_preference": r"""
WITH t AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY role, text)::INTEGER - 1 AS again, role, text FROM conversations
), a AS (
  SELECT conv_id, turn AS last_turn, again AS last_again, text AS answer FROM t WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, again DESC) = 1
), n AS (
  SELECT conv_id, coalesce(lead(conv_id) OVER (ORDER BY conv_id), first_value(conv_id) OVER (ORDER BY conv_id)) AS next_id FROM a
), p AS (
  SELECT t.conv_id AS pair_id, t.turn, t.again, t.role, t.text, b.answer,
         (t.turn, t.again) = (a.last_turn, a.last_again) AS is_last,
         t.turn < a.last_turn OR (t.turn = a.last_turn AND t.again <= a.last_again) AS up_to_last
  FROM t JOIN a USING (conv_id) JOIN n USING (conv_id) JOIN a b ON b.conv_id = n.next_id AND n.next_id <> n.conv_id
), split AS (
  SELECT pair_id, min((turn, again)) AS at FROM p
  WHERE (is_last AND text <> answer) OR NOT up_to_last GROUP BY pair_id
), parts AS (
  SELECT p.pair_id, CASE WHEN s.at IS NULL OR (turn, again) < s.at THEN 'prompt' ELSE 'chosen' END AS part, turn, again, role, text
  FROM p LEFT JOIN split s USING (pair_id)
  UNION ALL
  SELECT p.pair_id, 'rejected', turn, again, role, CASE WHEN is_last THEN answer ELSE text END
  FROM p JOIN split s USING (pair_id) WHERE up_to_last AND (turn, again) >= s.at
)
SELECT pair_id, part, turn, again, role, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS text,
       part <> 'prompt' AND role = 'assistant' AS trained
FROM parts
""",
}
