"""Sinks (A6-A10). Each is one distributed write; split and feature tables
are partitioned by ``split`` so readers prune to the split they need."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON records, one per line."""
    df.write.mode(mode).json(path)


def write_processed(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Processed rows; CSV with a header on request."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """All splits in one job, one folder per split."""
    w = df.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A10: long feature table, partitioned by split."""
    df.write.mode(mode).partitionBy("split").parquet(path)
