"""Label mapping.

The mapping is a two-column table ``(label, label_idx)``: distinct non-null
labels in ascending order, numbered from 0. It has one row per class, so it is
small; runtime sizes decide whether it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import bounded_broadcast, global_index


def label_mapping(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """(label, label_idx INT): sorted distinct non-null labels -> 0..n-1."""
    labels = df.select(F.col(label_col).alias("label")).where(F.col("label").isNotNull()).distinct()
    return global_index(labels, [F.col("label")], "label_idx").withColumn("label_idx", F.col("label_idx").cast("int"))


def apply_label_mapping(df: DataFrame, mapping: DataFrame, label_col: str = "sentiment",
                        mapping_rows: int | None = None, present: DataFrame | None = None) -> DataFrame:
    """Replace the label by its index. Labels missing from the mapping (and
    nulls) get ``max(mapped index present in df) + 1`` (0 when none is
    mapped). The mapping is broadcast when the caller knows that it has at most
    ``mapping_rows`` rows; otherwise runtime sizes decide.

    Nothing runs here: the value for missing labels is a scalar subquery over
    ``present``, the labels of ``df`` (``label_col``; read from ``df`` unless given)."""
    m = bounded_broadcast(mapping.select(F.col("label").alias("_lbl"), "label_idx"), mapping_rows)
    present = (df if present is None else present).select(F.col(label_col).alias("_lbl")).distinct()
    fill = present.join(m, "_lbl").agg(F.coalesce(F.max("label_idx"), F.lit(-1)) + 1).scalar()
    j = df.join(m, df[label_col] == m["_lbl"], "left").drop("_lbl")
    return j.withColumn(label_col, F.coalesce("label_idx", fill).cast("int")).drop("label_idx")


def label_distribution(df: DataFrame, mapping: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """(label_idx, label_name, n): counts per index with the original label,
    ``Unknown_<n>`` for indices with no label in the mapping."""
    counts = df.groupBy(F.col(label_col).alias("label_idx")).agg(F.count(F.lit(1)).alias("n"))
    names = mapping.select("label_idx", F.col("label").cast("string").alias("label_name"))
    return (counts.join(names, "label_idx", "left")
                  .select("label_idx",
                          F.coalesce("label_name", F.concat(F.lit("Unknown_"), F.col("label_idx").cast("string"))).alias("label_name"),
                          "n"))


def save_label_mapping(mapping: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet keeps the key type (a JSON dict would turn keys into strings)."""
    mapping.coalesce(1).write.mode(mode).parquet(path)


def load_label_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
