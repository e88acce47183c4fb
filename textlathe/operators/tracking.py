"""Experiment tracking as an append-only log table.

The log ``(dataset, seq, ts, artifact_type, value, params)`` is appended to,
never rewritten: a failed or concurrent writer cannot erase history. The
per-experiment index (one row per dataset and experiment, one column per
artifact slot) is a derived view.

Experiment numbering (G2) replays the rule "start a new experiment when the
split parameters recorded in the current experiment differ from the
parameters in force at the next write" without a sequential fold:

* ``g``: number of ``split_params`` records before the row (running count);
  rows with the same ``g`` share the same last recorded value ``v``;
* ``d``: ``v`` is non-empty and (unparsable, or one of the four keys differs
  from the row's current parameters);
* the first ``d`` row of each ``g`` group starts a new experiment (a new
  experiment clears ``v``, so later rows of the group do not count);
* experiment id = running count of starts.

Running counts use the skew-safe segmented scan, so one dataset with most of
the log does not end up on one task.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import range_tag, segmented_running

SLOTS = ("processed_data_file", "train_split", "test_split", "val_split", "train_features",
         "test_features", "val_features", "feature_extractor", "label_mapping", "split_params",
         "feature_params")
PARAM_KEYS = ("train_size", "test_size", "val_size", "random_state")
LOG_SCHEMA = "dataset string, seq bigint, ts timestamp, artifact_type string, value string, params string"
PARAMS_SCHEMA = "train_size double, test_size double, val_size double, random_state bigint"


def append_artifacts(spark: SparkSession, log_path: str, dataset: str, entries, current_params: str) -> None:
    """G1: append (artifact_type, value) entries for ``dataset`` with the
    parameters in force. ``seq`` is a nanosecond clock plus position."""
    from datetime import datetime, timezone
    base = time.time_ns()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(dataset, base + i, now, t, v, current_params) for i, (t, v) in enumerate(entries)]
    append_log(spark.createDataFrame(rows, LOG_SCHEMA), log_path)


def append_log(entries: DataFrame, log_path: str) -> None:
    """Append log rows of any number of datasets, the columns of the log in
    their order and types; a missing column is an error."""
    kinds = [c.split(" ") for c in LOG_SCHEMA.split(", ")]
    entries.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds]).write.mode("append").parquet(log_path)


def experiment_ids(log: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``log`` + ``exp_id`` (0-based per dataset; a null dataset is a
    dataset). A ``split_params`` record with a null value clears the recorded
    parameters. One range partitioning by (dataset, ts, seq) serves all scans:
    ``g`` rises along it."""
    order = [F.col("ts"), F.col("seq")]
    is_sp = F.coalesce(F.col("artifact_type") == "split_params", F.lit(False))
    x = range_tag(log, ["dataset"], order, num_partitions)
    x = segmented_running(x, ["dataset"], order, sums={"_g": F.when(is_sp, 1).otherwise(0)},
                          lasts={"_last": F.when(is_sp, F.struct("value"))}, inclusive=False, tagged=True)
    x = x.withColumn("_v", F.col("_last.value"))
    rec = F.from_json("_v", PARAMS_SCHEMA)
    cur = F.from_json("params", PARAMS_SCHEMA)
    valid = F.json_object_keys("_v").isNotNull()
    differ = F.lit(False)
    for k in PARAM_KEYS:
        differ = differ | ~rec[k].eqNullSafe(cur[k])
    d = F.col("_v").isNotNull() & (F.col("_v") != "") & (~valid | differ)
    x = x.withColumn("_d", d.cast("int"))
    x = segmented_running(x, ["dataset", "_g"], order, sums={"_dbefore": F.col("_d")}, inclusive=False, tagged=True)
    x = x.withColumn("_start", ((F.col("_d") == 1) & (F.coalesce("_dbefore", F.lit(0)) == 0)).cast("int"))
    x = segmented_running(x, ["dataset"], order, sums={"exp_id": F.col("_start")}, inclusive=True, tagged=True)
    return x.drop("_pid", "_g", "_last", "_v", "_d", "_dbefore", "_start").withColumn(
        "exp_id", F.col("exp_id").cast("int"))


def experiment_index(log: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """One row per (dataset, exp_id): created_at + the last value written
    to each slot (null when never written)."""
    e = experiment_ids(log, num_partitions)
    o = F.struct("ts", "seq")
    aggs = [F.min("ts").alias("created_at")]
    for s in SLOTS:
        aggs.append(F.max_by(F.when(F.col("artifact_type") == s, F.col("value")),
                             F.when(F.col("artifact_type") == s, o)).alias(s))
    return e.groupBy("dataset", "exp_id").agg(*aggs)


def dataset_experiments(index: DataFrame, dataset: str) -> DataFrame:
    """Experiments of one dataset (empty when unknown)."""
    return index.where(F.col("dataset") == dataset)


def list_datasets(log: DataFrame) -> DataFrame:
    """G5."""
    return log.select("dataset").distinct()


def get_params(index: DataFrame, slot: str = "split_params") -> DataFrame:
    """Parsed params of each experiment; null when missing or unparsable."""
    schema = PARAMS_SCHEMA if slot == "split_params" else "config map<string,string>, num_features bigint"
    ok = F.json_object_keys(slot).isNotNull()
    return index.select("dataset", "exp_id", F.when(ok, F.from_json(slot, schema)).alias(slot))


def feature_params_json(config_json: str, shapes: dict, num_features: int, filename: str) -> str:
    """The stored feature parameters."""
    d = {"config": json.loads(config_json), "num_features": num_features, "feature_extractor_filename": filename}
    d.update({f"{k}_features_shape": list(v) for k, v in shapes.items()})
    return json.dumps(d)


def events_as_log(events: DataFrame) -> DataFrame:
    """Tracking log derived from the ``events`` table: dataset = user,
    artifact = event type (``signup`` records split params), current
    parameters and recorded split params both carry ``floor(k / 50)`` as the
    seed."""
    seed = F.floor(F.get_json_object("props", "$.k").cast("double") / 50).cast("bigint")
    pj = F.concat(F.lit('{"train_size": 0.7, "test_size": 0.2, "val_size": 0.1, "random_state": '),
                  seed.cast("string"), F.lit("}"))
    is_sp = F.col("event_type") == "signup"
    return events.select(
        F.col("user_id").cast("string").alias("dataset"), F.col("event_id").alias("seq"), "ts",
        F.when(is_sp, F.lit("split_params")).otherwise(F.col("event_type")).alias("artifact_type"),
        F.when(is_sp, pj).otherwise(F.concat(F.lit("event-"), F.col("event_id").cast("string"))).alias("value"),
        pj.alias("params"))
