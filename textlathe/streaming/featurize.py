"""Structured Streaming entry points.

The cleaning functions are row-wise column expressions, so they apply to a
streaming DataFrame unchanged. Featurisation needs a per-document norm (an
aggregation), so it runs per micro-batch through ``foreachBatch`` with the
fitted model table (a small stored table) - each batch is a normal batch
plan, and the sink write is idempotent per batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.cleaning import spread, with_computed


def clean_stream(stream: DataFrame, text_col: str = "text") -> DataFrame:
    """B3-B15 without label mapping: drop null/blank text, add
    ``cleaned_text`` and ``text_length``, keep non-empty results."""
    s = stream.where(F.col(text_col).isNotNull() & ~T.is_blank(text_col))
    s = s.withColumn(text_col, T.lowercase(text_col))
    s = with_computed(s, {"cleaned_text": T.clean_text(text_col)})
    s = s.withColumn("processed_at", F.current_timestamp()).withColumn("text_length", T.text_length("cleaned_text"))
    return s.where(F.col("text_length") > 0)


def featurize_batches(model, id_col: str, out_path: str, checkpoint: str, prepare=None):
    """A ``foreachBatch`` function writing each batch's features to
    ``out_path/batch_id=<n>`` (overwrite per batch: replays are idempotent).
    The vocabulary is read once, not by every batch. ``prepare``: a function of
    the batch that goes before the model, such as :func:`clean_batch`."""
    from ..operators.features import held_model
    held = held_model(model)

    def run(batch: DataFrame, batch_id: int) -> None:
        feats = model.transform(prepare(batch) if prepare else batch, id_col, held=held)
        feats.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")
    return run


def clean_batch(batch: DataFrame, text_col: str = "text") -> DataFrame:
    """:func:`clean_stream` of one batch, over all cores: a batch of few files
    has few scan tasks."""
    return clean_stream(spread(batch), text_col)


def run_available(spark: SparkSession, stream: DataFrame, sink_path: str, checkpoint: str,
                  fmt: str = "parquet") -> None:
    """Process everything available now, then stop (batch-like trigger)."""
    q = (stream.writeStream.format(fmt).option("path", sink_path).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def document_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Stream, in batches of at most ``max_files`` files (default: one for each core), over the ``documents`` table of ``sf_dir``: the part files of a
    table folder, or a table that is a single file (a file stream watches
    folders, so that one is picked out of its folder by name)."""
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files or spark.sparkContext.defaultParallelism)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)
