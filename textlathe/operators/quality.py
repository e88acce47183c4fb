"""Data-quality checks and summaries (D1-D12) as report DataFrames.

Each report is one aggregation pass (map-side partial aggregation, a single
tiny reduce). The only driver-side step is reading the schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import constants as K


def _len(c: str):
    return F.length(F.col(c)).cast("long")


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)


def invalid_label_predicate(label_col: str, valid=K.VALID_LABELS):
    """True where the label is null or outside ``valid``."""
    return ~F.coalesce(F.col(label_col).isin(*valid), F.lit(False))


def invalid_labels(df: DataFrame, label_col: str = "sentiment", valid=K.VALID_LABELS) -> DataFrame:
    """(label, n): offending label values (null included) and their counts."""
    return (df.where(invalid_label_predicate(label_col, valid))
              .groupBy(F.col(label_col)).agg(F.count(F.lit(1)).alias("n")))


def missing_ratio(df: DataFrame) -> DataFrame:
    """(null_cells, total_cells, missing_ratio) over all columns."""
    cols = df.columns
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    total = F.count(F.lit(1)) * F.lit(len(cols))
    return df.agg(nulls.cast("long").alias("null_cells"), total.cast("long").alias("total_cells"),
                  F.try_divide(nulls.cast("double"), total.cast("double")).alias("missing_ratio"))


def text_length_bounds(df: DataFrame, text_col: str = "text", lo: int = K.MIN_TEXT_LENGTH,
                       hi: int = K.MAX_TEXT_LENGTH) -> DataFrame:
    return df.agg(F.count_if(_len(text_col) < lo).alias("short_texts"),
                  F.count_if(_len(text_col) > hi).alias("long_texts"))


def small_classes(df: DataFrame, label_col: str = "sentiment", min_n: int = K.MIN_SAMPLES_PER_CLASS) -> DataFrame:
    return (df.where(F.col(label_col).isNotNull()).groupBy(label_col)
              .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < min_n))


def quality_report(df: DataFrame, text_col: str = "text", label_col: str = "sentiment",
                   required=("text", "sentiment", "cleaned_text"), valid=K.VALID_LABELS,
                   max_missing: float = K.MAX_MISSING_RATIO, lo: int = K.MIN_TEXT_LENGTH,
                   hi: int = K.MAX_TEXT_LENGTH, min_class: int = K.MIN_SAMPLES_PER_CLASS) -> DataFrame:
    """(check, severity, value, threshold, passed): the seven checks in one
    aggregation plus one small per-class count.

    Errors: required columns, numeric label, label value set, missing ratio.
    Warnings: short texts, long texts, small classes.
    """
    spark = df.sparkSession
    missing = [c for c in required if c not in df.columns]
    if missing:
        return spark.createDataFrame(
            [("required_columns", "error", float(len(missing)), 0.0, False)],
            "check string, severity string, value double, threshold double, passed boolean")
    numeric = is_numeric(df, label_col)
    cols = df.columns
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    # Two-level aggregation: per class, then over the (few) class rows; the
    # small-class count needs the per-class counts, the rest just sums up.
    per_class = df.groupBy(F.col(label_col).alias("_y")).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(invalid_label_predicate(label_col, valid)) if numeric else F.lit(0)).alias("bad"),
        nulls.alias("nulls"),
        F.count_if(_len(text_col) < lo).alias("short"),
        F.count_if(_len(text_col) > hi).alias("long"))
    both = per_class.agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"),
        F.try_divide(F.sum("nulls").cast("double"), (F.sum("n") * len(cols)).cast("double")).alias("mr"),
        F.sum("short").alias("short"), F.sum("long").alias("long"),
        F.count_if(F.col("_y").isNotNull() & (F.col("n") < min_class)).alias("small"))
    rows = [
        ("required_columns", "error", F.lit(0.0), F.lit(0.0), F.lit(True)),
        ("label_numeric", "error", F.lit(1.0 if numeric else 0.0), F.lit(1.0), F.lit(numeric)),
        ("label_values", "error", F.lit(None).cast("double") if not numeric else F.col("bad").cast("double"),
         F.lit(0.0), F.lit(False) if not numeric else F.coalesce(F.col("bad") == 0, F.lit(True))),
        ("missing_ratio", "error", F.col("mr"), F.lit(float(max_missing)),
         F.coalesce(F.col("mr") <= max_missing, F.lit(True))),
        ("short_texts", "warning", F.col("short").cast("double"), F.lit(float(lo)), F.col("short") == 0),
        ("long_texts", "warning", F.col("long").cast("double"), F.lit(float(hi)), F.col("long") == 0),
        ("small_classes", "warning", F.col("small").cast("double"), F.lit(float(min_class)), F.col("small") == 0),
    ]
    structs = [F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), v.alias("value"),
                        t.alias("threshold"), p.alias("passed")) for c, s, v, t, p in rows]
    return both.select(F.inline(F.array(*structs)))


def validate(df: DataFrame, **kw) -> bool:
    """Raise on a failed error-level check; return True otherwise."""
    bad = [r for r in quality_report(df, **kw).collect() if r.severity == "error" and not r.passed]
    if bad:
        raise ValueError("Data quality validation failed: " + ", ".join(f"{r.check}={r.value}" for r in bad))
    return True


def quarantine(df: DataFrame, label_col: str = "sentiment", valid=K.VALID_LABELS) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows by the label-value predicate."""
    p = invalid_label_predicate(label_col, valid)
    return df.where(~p), df.where(p)


def null_summary(df: DataFrame) -> DataFrame:
    """(column, dtype, nulls, total_rows): one pass, unpivoted."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', '{df.schema[c].dataType.simpleString()}', _n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, dtype, nulls)", "_total AS total_rows")


def class_balance(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """(label, n, share): share over *all* rows (null labels stay in the
    denominator, as a value count divided by the row count would)."""
    from pyspark.sql import Window
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # over the per-class rows only
    return (counts.withColumn("share", F.col("n") / total)
                  .where(F.col(label_col).isNotNull()))


def length_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """mean, sample std, min, max, exact interpolated median of text length.

    The exact median keeps a count per distinct length (mergeable map-side),
    so its memory is bounded by the number of distinct lengths, not rows."""
    L = _len(text_col)
    return df.where(F.col(text_col).isNotNull()).agg(
        F.avg(L).alias("mean"), F.stddev_samp(L).alias("std"), F.min(L).alias("min"),
        F.max(L).alias("max"), F.median(L).alias("median"))
