"""Corpus pipeline: quality classifier, SimHash near-dedup, mixing of sources,
BPE encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.llm import bpe_stream, mixing, simhash
from textlathe.llm.common import written
from textlathe.llm.queries_d import quality_scores

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    """Id and text, and the whole row apart, so that no column of ``docs`` can
    clash with one that an operator adds."""
    return docs.select("doc_id", "text", *more, F.struct("*").alias("_row"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Without a usable label
    (none outside the held-out part for these documents) there is no classifier,
    and a ValueError instead of an empty corpus; no documents give none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_scores(_rows(docs), labels, required=True).where("predicted = 1").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest doc_id."""
    return simhash.deduplicate(docs, words=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix reads it, in training order."""
    placed = mixing.curriculum(_rows(docs, "source"), carry=["_row"])
    return mixing.training_order(placed).select("_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix and a digest of their decoded text."""
    done = bpe_stream.transcode(docs, TOKENIZER)
    return done.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [("quality classifier", keep_quality), ("SimHash near-dedup", drop_near_copies),
          ("source mixing", mix_sources), ("BPE encoding", encode)]
ORACLE_SQL = None  # the classifier and the fingerprints have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
