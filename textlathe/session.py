"""Session helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with the settings the library is tuned for, and the one
place that resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators rely on. AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "textlathe", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the cluster's own session."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the cluster (a shared file system path) and is
    used as is. Only when it is unset (local tests) is a private folder made.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a shared folder is needed on a cluster")
        d = tempfile.mkdtemp(prefix="textlathe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "tables", name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: several
    readers share one computation and a lost executor loses none of it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rooted_files(spark: SparkSession, folder: str) -> DataFrame | None:
    """(path) of every file below ``folder`` on Spark's file system, listed by
    Spark and named as ``folder`` was given; None when there is no such folder
    or no file in it. Contents are not read."""
    folder = folder.rstrip("/")
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root) or fs.getContentSummary(root).getFileCount() == 0:
        return None
    full = fs.makeQualified(root).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.concat(F.lit(folder), F.substr("path", F.lit(len(full) + 1))).alias("path"))
