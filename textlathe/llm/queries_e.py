"""Query of the nearest-neighbour operator (op3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlathe.llm import vptree
from textlathe.llm.common import table

NEIGHBOURS = 5
FACTOR = 1.2


def op3_vptree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every row whose vec_id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    trees = vptree.index(rows, k=NEIGHBOURS)
    return vptree.nearest(trees, rows.where("vec_id % 50 = 0"), k=NEIGHBOURS, factor=FACTOR)


QUERIES = {"op3_vptree_neighbours": op3_vptree_neighbours}
# Exact search; the query's recall is tested to be complete on such tables.
OP3_SQL = f"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM p
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""
ORACLE = {"op3_vptree_neighbours": OP3_SQL}
