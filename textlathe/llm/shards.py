"""Sharding by jump consistent hash (Lamping and Veach).

A 64-bit key and a shard count give a shard by a short arithmetic loop, with
no ring table. Appending a shard moves about 1/(n+1) of the keys, all of them
into the new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlathe.llm.common import copies_apart, id_text, row_digest

# FIXED VALUES: the published generator step of jump consistent hash.
_MULTIPLIER = np.uint64(2862933555777941757)
_SCALE = float(1 << 31)


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard in ``[0, n_shards)`` for each unsigned 64-bit key, all at once."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = np.array(keys, dtype=np.uint64)
    shard = np.zeros(len(key), dtype=np.int64)
    jump = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    with np.errstate(over="ignore"):
        while len(live):
            shard[live] = jump[live]
            key[live] = key[live] * _MULTIPLIER + np.uint64(1)
            spread = _SCALE / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
            jump[live] = ((shard[live] + 1) * spread).astype(np.int64)
            live = live[jump[live] < n_shards]
    return shard


def key64(key: str | Column) -> Column:
    """A stable key as 64 bits: the first half of the md5 of its text (null:
    of the empty text), as a signed long with the same bits."""
    return F.conv(F.substring(F.md5(id_text(key)), 1, 16), 16, -10).cast("long")


def shard_of(key: str | Column, n_shards: int) -> Column:
    """Shard of a stable key (any type that casts to text)."""

    @F.pandas_udf("int")
    def jump(k: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(k.to_numpy(dtype=np.int64).view(np.uint64), n_shards).astype(np.int32))

    return jump(key64(key))


def assign_shards(df: DataFrame, key: str = "doc_id", n_shards: int = 16) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (the shard after one is appended).

    Null keys are one key. Equal keys always share a shard, whatever the other
    columns hold. No shuffle. Columns named ``shard`` or ``grown_shard`` are
    replaced.
    """
    keep = [F.col(f"`{c}`") for c in df.columns if c not in ("shard", "grown_shard")]
    return df.select(*keep, shard_of(key, n_shards).alias("shard"),
                     shard_of(key, n_shards + 1).alias("grown_shard"))


def shard_slots(df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = 16,
                buckets: int = 4096) -> DataFrame:
    """One row per row of ``df``: key, ``size`` (UTF-8 bytes of the text, null
    none, plus 1), ``text_crc32``, ``law``, ``shard``, ``grown_shard`` and
    ``slot``, a gapless position from 0 inside the shard.

    A shard is ordered by md5(key, text), and cut by the digest's first three
    hex digits into at most ``buckets`` (4096) buckets, so numbering never
    gathers a shard in one task: each bucket is scanned by itself and a table of
    shards x buckets counts gives the offsets. Repeated rows (equal key and
    text) are counted before the shuffle and expanded after numbering, in blocks
    of 10,000 that are dealt over the tasks: a row that repeats a billion times
    is one row in the shuffles before and 100,000 in the last. Empty input gives
    no rows.
    """
    if buckets != 4096:
        raise ValueError("buckets are the first three hex digits of the digest")
    utf8 = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    rows = df.select(F.col(key).alias("_key"), (F.octet_length(utf8) + 1).cast("long").alias("size"),
                     F.crc32(utf8).alias("text_crc32"), row_digest(key, text).alias("_order"))
    once = rows.groupBy("_key", "size", "text_crc32", "_order").agg(F.count(F.lit(1)).alias("_copies"))
    once = assign_shards(once, "_key", n_shards).withColumn("_bucket", F.substring("_order", 1, 3))
    order = Window.partitionBy("shard", "_bucket").orderBy("_order", "_key").rowsBetween(
        Window.unboundedPreceding, -1)
    local = once.withColumn("_before", F.coalesce(F.sum("_copies").over(order), F.lit(0)))
    counts = once.groupBy("shard", "_bucket").agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (copies_apart(local.join(offsets, ["shard", "_bucket"]), "_order")
            .select(F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_offset") + F.col("_before") + F.col("_copy")).cast("long").alias("slot"),
                    "grown_shard"))
