"""Queries of cross-tokenizer alignment (op11) and HTML extraction (op12)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.llm import align, html_text
from textlathe.llm.common import table


def alignment_report(docs: DataFrame) -> DataFrame:
    aligned = align.align(docs, public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    none = F.lit(0).cast("long")
    return (aligned.select("doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
            .join(align.score(aligned), "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", none).alias("n_best"),
                    F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every whole document."""
    return alignment_report(table(spark, sf_dir, "documents"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"), carry=["url"])


QUERIES = {"op11_token_alignment": op11_token_alignment, "op12_main_text": op12_main_text}
ORACLE: dict[str, str] = {}
