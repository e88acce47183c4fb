"""Queries of the token operators (op4, op9)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.llm import bpe_stream, token_files
from textlathe.llm.common import table


def op9_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the streaming transducer and decoded again;
    the digests are taken from the ids and the decoded text."""
    done = bpe_stream.transcode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(bpe_stream.ids_text("ids"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids (end id 2 appended) written to token files in
    ascending doc_id order, and the files read back."""
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        out_dir=token_files.token_folder(spark), end_id=2)
    return token_files.read_token_files(manifest).select(
        F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op4_token_files": op4_token_files, "op9_bpe_transducer": op9_bpe_transducer}
ORACLE: dict[str, str] = {}
