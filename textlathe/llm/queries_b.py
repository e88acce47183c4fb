"""Queries of the near-duplicate operators (op7, op10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlathe.llm import embed_dedup, simhash
from textlathe.llm.common import table


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component it is linked into."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, words=3, distance=2).select("doc_id", "fingerprint", "component_id")


def op10_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's direct links within its label and its component."""
    return embed_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


QUERIES = {"op10_embedding_groups": op10_embedding_groups, "op7_simhash_groups": op7_simhash_groups}
# All pairs of a label, then the closure of the links.
OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a
), c AS (
  SELECT a, min(b) AS low FROM reach GROUP BY a
), n AS (
  SELECT a, count(*) AS n FROM l GROUP BY a
)
SELECT m.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c.low, m.vec_id) AS component_id,
       coalesce(m.vec_id = coalesce(c.low, m.vec_id), false) AS kept
FROM embeddings m LEFT JOIN c ON c.a = m.vec_id LEFT JOIN n ON n.a = m.vec_id
"""
ORACLE: dict[str, str] = {"op10_embedding_groups": OP10_SQL}
