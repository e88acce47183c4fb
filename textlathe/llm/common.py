"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlathe.session import ensure_checkpoint_dir, scratch_path

# A word is a maximal run of characters other than the six ASCII white-space
# characters (the set that ``bytes.split()`` splits on).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage on storage that every executor sees, so a lost executor
    costs only its running tasks, and several readers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable ``checkpoint()`` in the shared folder (small iterative state)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def copies_apart(df: DataFrame, key: str, block: int = 10_000) -> DataFrame:
    """One row for each of ``_copies`` copies, numbered by ``_copy`` from 0.
    Copies are cut into blocks, dealt out by ``key`` and block number, and
    expanded there: no array holds more than ``block`` numbers, or a number for
    each block, and the copies of one row come out of many tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.col("_copies") - 1
    start = F.col("_block") * block
    return (df.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / block))).alias("_block"))
            .repartition(n, key, "_block")
            .select("*", F.explode(F.sequence(start, F.least(last, start + (block - 1)))).alias("_copy")).drop("_block"))


def id_text(col: str | Column) -> Column:
    """An id as text, null as the empty string (so that null ids still hash)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def row_digest(key: str, text: str) -> Column:
    """md5 hex of key and text: a random but reproducible order of rows.
    Only rows equal in both columns share it."""
    return F.md5(F.concat(id_text(key), F.lit(":"), F.coalesce(F.col(text).cast("string"), F.lit(""))))
