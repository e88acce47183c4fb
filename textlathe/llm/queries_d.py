"""Queries of the learning operators (op1, op8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textlathe.llm import lm, quality
from textlathe.llm.common import table

QUALITY_THRESHOLD = 0.7


def quality_scores(docs: DataFrame, labels: DataFrame, *, required: bool = False) -> DataFrame:
    """All documents scored by a model that never sees held-out labels.
    ``required``: documents without any usable label raise a ValueError."""
    model = quality.fit(docs, labels.where(~quality.held_out("doc_id")))
    if required and model is None and not docs.isEmpty():
        raise ValueError("no usable quality label for these documents: nothing can be told good or bad")
    return quality.score(docs, model, threshold=QUALITY_THRESHOLD)


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_log_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model learnt from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = quality.held_out("doc_id", parts=5, part=1)
    return lm.fit_and_score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op8_log_bloom_lm": op8_log_bloom_lm, "op1_quality_neighbours": op1_quality_neighbours}
ORACLE: dict[str, str] = {}
