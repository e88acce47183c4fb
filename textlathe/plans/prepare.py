"""End-to-end preparation of a labelled text dataset (the reference's CLI
flow) as Spark jobs:

scan -> column check/aliasing -> clean + label map -> write processed ->
stratified split (read back from the written table) -> write splits ->
fit features on train only -> transform all splits -> write features and the
model -> append artifacts and parameters to the tracking log.

Every written table goes under ``out_dir`` (a shared path on a cluster).
Writing the processed table cuts the lineage of the expensive text cleaning
before the split reads it twice.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, features, labels, split, tracking
from ..operators.features import LIVE_CONFIG, FeatureConfig
from ..session import ensure_checkpoint_dir, materialize


def fit_on_train(split_df: DataFrame, text_col: str = "cleaned_text", label_col: str = "sentiment",
                 id_col: str = "doc_id", cfg: FeatureConfig = LIVE_CONFIG):
    """(stored term counts ``(id, split, label, terms)`` of every split, model
    fitted on ``split == 'train'`` rows only)."""
    for c in (text_col, label_col, "split"):
        if c not in split_df.columns:
            raise ValueError(f"{c} column not found in split data.")
    # n-grams are counted once, for all splits; fit and transform read the stored counts
    terms = materialize(features.doc_terms(split_df, text_col, cfg, [id_col, "split", label_col]), "doc-terms")
    train = terms.where(F.col("split") == "train").select(id_col, label_col, "terms")
    return terms, features.fit(split_df, text_col, label_col, id_col, cfg, terms=train)


def features_for_splits(split_df: DataFrame, text_col: str = "cleaned_text", label_col: str = "sentiment",
                        id_col: str = "doc_id", cfg: FeatureConfig = LIVE_CONFIG):
    """Fit on ``split == 'train'`` rows only, transform every split.

    Returns (long features ``(split, id, sel_idx, term, value)``, model)."""
    terms, model = fit_on_train(split_df, text_col, label_col, id_col, cfg)
    out = features.transform(model, split_df, id_col, [id_col, "split"], text_col, terms.drop(label_col))
    return out, model


def prepare(spark: SparkSession, df: DataFrame, out_dir: str, dataset: str,
            text_column: str = "text", label_column: str = "sentiment", id_col: str = "doc_id",
            params: split.SplitParams = split.SplitParams(), cfg: FeatureConfig = LIVE_CONFIG,
            map_labels: bool = True, log_path: str | None = None,
            lexicon: DataFrame | None = None) -> DataFrame:
    """Run the whole flow; returns the summary DataFrame (stage, value).

    Inputs need no id: without ``id_col`` one is derived from the row (see
    :func:`cleaning.with_row_id`). ``lexicon``: as in ``process_data``."""
    out_dir = out_dir.rstrip("/")
    log_path = log_path or f"{out_dir}/tracking"
    df = cleaning.standardize_columns(df, text_column, label_column)
    if id_col not in df.columns:
        df = cleaning.with_row_id(df, id_col)
    # the raw input is read twice: for this report, and for cleaning
    ensure_checkpoint_dir(spark)
    report = cleaning.label_report(df).checkpoint()
    raw_rows = report.agg(F.sum("rows_in")).first()[0] or 0
    mapping = present = None
    if map_labels:
        labels.save_label_mapping(labels.label_mapping(report.where("rows_in > dropped_null")), f"{out_dir}/label_mapping")
        mapping = labels.load_label_mapping(spark, f"{out_dir}/label_mapping")
        present = report.where("rows_out > 0")
    processed = cleaning.process_data(df, "text", "sentiment", mapping, lexicon=lexicon, id_col=id_col, present=present)
    processed.write.mode("overwrite").parquet(f"{out_dir}/processed")
    processed = spark.read.parquet(f"{out_dir}/processed")
    n_processed = processed.count()
    splits = split.stratified_split(processed, "sentiment", id_col, params)
    splits.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/splits")
    splits = spark.read.parquet(f"{out_dir}/splits")
    sizes = {r["split"]: r["n"] for r in splits.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    feats, model = features_for_splits(splits, "cleaned_text", "sentiment", id_col, cfg)
    feats.write.mode("overwrite").partitionBy("split").parquet(f"{out_dir}/features")
    model.save(f"{out_dir}/extractor")
    split_params = dict(asdict(params), train_samples=sizes.get("train", 0),
                        test_samples=sizes.get("test", 0), val_samples=sizes.get("val", 0))
    shapes = {name: (sizes.get(name, 0), model.n_selected) for name in ("train", "test", "val")}
    feature_params = tracking.feature_params_json(cfg.to_json(), shapes, model.n_selected, f"{out_dir}/extractor")
    current = json.dumps({k: split_params[k] for k in ("train_size", "test_size", "val_size", "random_state")})
    entries = [("processed_data_file", f"{out_dir}/processed"),
               ("label_mapping", f"{out_dir}/label_mapping" if map_labels else None),
               ("train_split", f"{out_dir}/splits/split=train"),
               ("test_split", f"{out_dir}/splits/split=test"),
               ("val_split", f"{out_dir}/splits/split=val"),
               ("split_params", json.dumps(split_params)),
               ("feature_extractor", f"{out_dir}/extractor"),
               ("train_features", f"{out_dir}/features/split=train"),
               ("test_features", f"{out_dir}/features/split=test"),
               ("val_features", f"{out_dir}/features/split=val"),
               ("feature_params", feature_params)]
    tracking.append_artifacts(spark, log_path, dataset, [(t, v) for t, v in entries if v is not None], current)
    rows = [("raw_rows", raw_rows), ("processed_rows", n_processed),
            ("train_rows", sizes.get("train", 0)), ("test_rows", sizes.get("test", 0)),
            ("val_rows", sizes.get("val", 0)), ("num_features", model.n_selected)]
    return spark.createDataFrame(rows, "stage string, value bigint")


def prepare_path(spark: SparkSession, path: str, out_dir: str, dataset: str, text_column: str = "text",
                 label_column: str = "sentiment", schema: str | None = None, **options) -> DataFrame:
    """Path to summary: scan a CSV or JSON file (``download_raw``), then
    :func:`prepare`."""
    from ..sources.readers import download_raw
    return prepare(spark, download_raw(spark, path, schema), out_dir, dataset, text_column, label_column, **options)


def load_and_validate(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
                      **checks) -> DataFrame:
    """Read a processed table and run the quality checks (raises on a
    failed error-level check). A CSV has no types: ``schema`` gives them, or
    they are inferred."""
    from ..operators.quality import validate
    if fmt == "csv":
        reader = spark.read.option("header", True).option("escape", '"')
        df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    validate(df, **checks)
    return df


def load_process_save(spark: SparkSession, raw_path: str, out_path: str, text_column: str = "text",
                      label_column: str = "sentiment", schema: str | None = None) -> DataFrame:
    """Scan raw (CSV ladder or JSON), standardise, process, write; returns
    the written table read back."""
    from ..sources.readers import download_raw
    raw = cleaning.standardize_columns(download_raw(spark, raw_path, schema), text_column, label_column)
    cleaning.process_data(raw).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
