"""Standard inputs built from the driver tables.

Mapping used throughout (tables in ``sf_dir``):

* text = ``documents.text``, sentiment = ``labels.quality`` (inner join on
  ``doc_id``); string labels = ``documents.lang`` (4) or ``source`` (20).
* tracking log = ``events``: dataset = ``user_id``, artifact type =
  ``event_type``, order = (``ts``, ``event_id``).
* run log = ``events``: experiment = ``event_type``, run = ``event_id``,
  name = ``user_id``, metric = ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_docs(spark: SparkSession, sf_dir: str, label: str = "quality") -> DataFrame:
    """(doc_id, text, sentiment): documents with a label, label = quality."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("sentiment"))
    return docs.join(labels, "doc_id")


def lang_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, sentiment = lang string) over all documents."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("sentiment")))


# Oracle-side equivalents (DuckDB SQL over the pre-registered views).
LABELLED_DOCS_SQL = ("SELECT d.doc_id, d.text, l.quality AS sentiment "
                     "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
LANG_DOCS_SQL = "SELECT doc_id, text, lang AS sentiment FROM documents"
