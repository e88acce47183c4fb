"""Row-wise cleaning operators (B1-B17). DataFrame in, DataFrame out.

All are narrow transformations (no shuffle), expressed with built-in
functions, so Catalyst pushes filters and column pruning to the scan and the
work stays in whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from .joins import bounded_broadcast


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when the input has fewer partitions than the
    cluster has cores (few large files of long texts). A no-op on inputs that
    already come in many splits, as at scale."""
    sc = df.sparkSession.sparkContext
    want = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def with_computed(df: DataFrame, columns: dict) -> DataFrame:
    """Add expensive computed columns so that later filters on them are not
    pushed below the computation.

    A ``where`` on a projected column is pushed through the projection by
    substituting the expression, so an expensive text expression would run
    twice (and before any ``repartition``). Producing the columns with a
    one-row ``inline`` generator keeps a single evaluation: filters on
    generator output stay above it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))))


# B1 / D1
def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}. Available columns: {df.columns}")
    return df


# B2
def standardize_columns(df: DataFrame, text_column: str, label_column: str,
                        text_name: str = "text", label_name: str = "sentiment") -> DataFrame:
    """Copy the chosen columns to the canonical ``text`` / ``sentiment``."""
    require_columns(df, [text_column, label_column])
    return df.withColumns({text_name: F.col(text_column), label_name: F.col(label_column)})


# A5
def normalize_nulls(df: DataFrame, columns=None, tokens=K.NA_TOKENS) -> DataFrame:
    """String fields equal to a missing-value token become null."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.when(F.col(c).isin(*tokens), F.lit(None)).otherwise(F.col(c)) for c in cols})


def with_row_id(df: DataFrame, id_col: str = "doc_id", num_partitions: int | None = None) -> DataFrame:
    """Add a unique id to rows that have none: ``<md5 of the row>-<number
    inside equal rows>``. The same rows get the same ids under any
    partitioning; equal rows are numbered over range partitions, so a row that
    repeats very often is not numbered by one task."""
    from .joins import segmented_rank
    digest = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    rows = df.withColumn("_digest", digest).withColumn("_row", F.monotonically_increasing_id())
    ranked = segmented_rank(rows, ["_digest"], [F.col("_row")], "_n", num_partitions)
    return ranked.withColumn(id_col, F.concat_ws("-", "_digest", F.col("_n").cast("string"))).drop("_digest", "_row", "_n")


# B3
def drop_null_keys(df: DataFrame, keys=("text", "sentiment")) -> DataFrame:
    return df.na.drop(subset=list(keys))


# B4
def lowercase_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn(text_col, T.lowercase(text_col))


# B5
def drop_blank_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.where(~T.is_blank(text_col))


def apply_cleaning(df: DataFrame, text_col: str = "text", label_col: str = "sentiment") -> DataFrame:
    """B3 -> B4 -> B5; whether a text is blank does not depend on its case, so
    that is read off the text before it is lowercased."""
    return lowercase_text(drop_blank_text(drop_null_keys(df, (text_col, label_col)), text_col), text_col)


# B6
def cleaning_report(df: DataFrame, text_col: str = "text", label_col: str = "sentiment") -> DataFrame:
    """One row: rows_in, dropped_null, dropped_blank, rows_out (one pass)."""
    return df.agg(*_report_columns(text_col, label_col))


def label_report(df: DataFrame, text_col: str = "text", label_col: str = "sentiment") -> DataFrame:
    """:func:`cleaning_report` of every label, null included: one pass that
    serves the row counts, the label mapping and the labels left by cleaning."""
    return df.groupBy(label_col).agg(*_report_columns(text_col, label_col))


def _report_columns(text_col: str, label_col: str) -> list:
    null_key = F.col(text_col).isNull() | F.col(label_col).isNull()
    blank = ~null_key & T.is_blank(text_col)  # in any case
    return [F.count(F.lit(1)).alias("rows_in"), F.count_if(null_key).alias("dropped_null"),
            F.count_if(blank).alias("dropped_blank"), F.count_if(~null_key & ~blank).alias("rows_out")]


# B14 / B15 / B16
def process_data(df: DataFrame, text_col: str = "text", label_col: str = "sentiment",
                 mapping: DataFrame | None = None, timestamp: bool = True, lexicon: DataFrame | None = None,
                 id_col: str = "doc_id", present: DataFrame | None = None) -> DataFrame:
    """Cleaning, optional label mapping, ``cleaned_text``, metadata columns,
    and removal of rows whose cleaned text is empty. One lazy plan.

    ``mapping`` is a ``(label, label_idx)`` table from
    :func:`textlathe.operators.labels.label_mapping`; when given, the label
    column is replaced by its index (``present``: the labels that cleaning
    leaves, if the caller has them). ``lexicon`` is a ``(form, lemma)`` table
    that goes before the built-in lemma rules; it needs ``id_col``, unique.
    """
    from .labels import apply_label_mapping
    out = apply_cleaning(df, text_col, label_col)
    if mapping is not None:
        out = apply_label_mapping(out, mapping, label_col, present=present)
    if lexicon is None:
        out = with_computed(out, {"cleaned_text": T.clean_text(text_col)})
    else:
        out = out.withColumn("_tokens", T.clean_tokens(text_col, lemmas=False))
        out = lemmatize_with_lexicon(out, id_col, "_tokens", lexicon, out="_lemmas")
        out = out.withColumn("cleaned_text", F.array_join("_lemmas", " ")).drop("_tokens", "_lemmas")
    if timestamp:
        out = out.withColumn("processed_at", F.current_timestamp())
    out = out.withColumn("text_length", T.text_length("cleaned_text"))
    return out.where(F.col("text_length") > 0)


# B17
def features_labels(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """(features, label): prefers ``cleaned_text`` over ``text``; drops rows
    where either is null."""
    if "cleaned_text" in df.columns:
        f = "cleaned_text"
    elif "text" in df.columns:
        f = "text"
    else:
        raise ValueError("No text column found in DataFrame")
    if label_col not in df.columns:
        raise ValueError(f"No {label_col} column found in DataFrame")
    return df.select(F.col(f).alias("features"), F.col(label_col).alias("label")).na.drop()


# B12 with a lexicon
def lemmatize_with_lexicon(df: DataFrame, id_col: str, tokens_col: str, lexicon: DataFrame,
                           lexicon_rows: int | None = None, out: str = "lemmas") -> DataFrame:
    """Replace tokens found in a ``(form, lemma)`` lexicon; others keep the
    rule-based lemma. A form that the lexicon repeats has one lemma, the first
    in order. Tokens are exploded with their position, joined to the
    lexicon (broadcast when its size is known and bounded) and regrouped in
    order: one shuffle by document."""
    ex = df.select(id_col, F.posexplode(tokens_col).alias("_pos", "_tok"))
    one = lexicon.where("form IS NOT NULL").groupBy(F.col("form").alias("_tok")).agg(F.min("lemma").alias("_lem"))
    lx = bounded_broadcast(one, lexicon_rows)
    j = ex.join(lx, "_tok", "left").withColumn("_lem", F.coalesce("_lem", T.lemma_rule(F.col("_tok"))))
    g = j.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("_pos", "_lem"))).alias("_c"))
    g = g.select(id_col, F.transform("_c", lambda x: x["_lem"]).alias(out))
    return df.join(g, id_col, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
