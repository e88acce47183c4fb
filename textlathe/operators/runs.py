"""Run log and model registry as tables (H1-H7).

Run log: ``(experiment, run_id, run_name, start_time, params MAP<STRING,STRING>,
metrics MAP<STRING,DOUBLE>, tags MAP<STRING,STRING>, artifacts ARRAY<STRING>)``;
parameters of a model carry its name as a prefix (``prefixed``). Registry: ``(name, run_id, ts, stage)`` with
versions numbered per name. Orderings that would put one experiment or model
on a single task use the skew-safe segmented rank.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import rooted_files
from .joins import global_index, segmented_rank

RUN_SCHEMA = ("experiment string, run_id string, run_name string, start_time timestamp, "
              "params map<string,string>, metrics map<string,double>, tags map<string,string>, artifacts array<string>")


def log_runs(runs: DataFrame, path: str) -> None:
    """H1: append runs (params, metrics, tags as maps) to the current version of
    the log under ``path``; a new log begins with its first version."""
    spark = runs.sparkSession
    current = _current(spark, path)
    if current is None:
        current = _point(spark, path, 1)
    runs.write.mode("append").parquet(f"{path}/{current}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The runs of the current version of the log; none if there is no log or
    nothing was appended."""
    current = _current(spark, path)
    if current is None or rooted_files(spark, f"{path}/{current}") is None:
        return spark.createDataFrame([], RUN_SCHEMA)
    return spark.read.schema(RUN_SCHEMA).parquet(f"{path}/{current}")


def _current(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest version that the pointer table names."""
    if rooted_files(spark, f"{path}/versions") is None:
        return None
    row = spark.read.schema("version long, folder string").parquet(f"{path}/versions") \
        .agg(F.max(F.struct("version", "folder")).alias("m")).first()
    return row["m"]["folder"] if row["m"] else None


def _point(spark: SparkSession, path: str, version: int, folder: str | None = None) -> str:
    folder = folder or f"runs-{uuid.uuid4().hex}"
    row = spark.createDataFrame([(version, folder)], "version long, folder string")
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return folder


def prefixed(params, model: str):
    """H1: a parameter map with its keys prefixed by the model's name."""
    return F.transform_keys(params, lambda k, v: F.concat(F.lit(f"{model}_"), k))


def run_log_long(runs: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """H1 long form: (run_id, kind, key, value) for params, metrics, tags and
    artifacts (key: position from 0). With ``files`` (column ``path``, e.g.
    :func:`artifact_listing`) artifacts that are not among them are left out,
    by a semi-join; other entries are not shuffled."""
    def entries(kind, column):
        return F.transform(F.map_entries(column), lambda e: F.struct(
            F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].cast("string").alias("value")))
    named = F.transform("artifacts", lambda a, i: F.struct(
        F.lit("artifact").alias("kind"), i.cast("string").alias("key"), a.alias("value")))
    none = F.array().cast("array<struct<kind:string,key:string,value:string>>")
    every = F.concat(*[F.coalesce(x, none) for x in (
        entries("param", "params"), entries("metric", "metrics"), entries("tag", "tags"), named)])
    long = runs.select("run_id", F.inline(every))
    if files is None:
        return long
    stored = files.select(F.col("path").alias("_path"))
    present = long.where("kind = 'artifact'").join(stored, F.col("value") == F.col("_path"), "left_semi")
    return long.where("kind <> 'artifact'").unionByName(present)


def artifact_listing(spark: SparkSession, folder: str) -> DataFrame:
    """(path): the files below ``folder`` and the folders that hold them, named
    as ``folder`` was given. An absent folder lists nothing."""
    files = rooted_files(spark, folder)
    if files is None:
        return spark.createDataFrame([], "path string")
    up = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(F.explode(F.array("path", up)).alias("path")).distinct()


def experiments(runs: DataFrame) -> DataFrame:
    """H2: one row per experiment name (get-or-create keeps the first):
    created = first start time, experiment_id numbered by creation."""
    first = runs.groupBy("experiment").agg(F.min("start_time").alias("created"))
    return global_index(first, [F.col("created"), F.col("experiment")], "experiment_id").select(
        "experiment", "created", F.col("experiment_id").cast("int").alias("experiment_id"))


def get_or_create(existing: DataFrame, names: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    """H2 append set: requested names not yet present (anti join). With ``tags``
    every new experiment carries them in ``tags``; present ones keep their own."""
    new = names.select("experiment").distinct().join(existing.select("experiment"), "experiment", "left_anti")
    if tags is None:
        return new
    pairs = [F.lit(x) for kv in sorted(tags.items()) for x in kv]
    return new.withColumn("tags", F.create_map(*pairs).cast("map<string,string>"))


def experiment_runs(runs: DataFrame, experiment: str) -> DataFrame:
    """H3: runs of one experiment (empty when absent)."""
    return runs.where(F.col("experiment") == experiment).select("run_id", "run_name", "start_time")


def compare_runs(runs: DataFrame, experiment: str, metric: str = "f1") -> DataFrame:
    """H4: per run name (equal names collapse to the earliest-started run,
    the one a newest-first listing would visit last; a null name is a name),
    the metric (missing -> 0.0) with all parameters and metrics, ranked best
    first."""
    r = runs.where(F.col("experiment") == experiment)
    value = F.coalesce(F.col("metrics")[metric], F.lit(0.0))
    first = F.min_by(F.struct("run_id", value.alias("metric_value"), "params", "metrics"),
                     F.struct("start_time", "run_id"))
    r = r.groupBy("run_name").agg(first.alias("_f")).select("run_name", "_f.*")
    ranked = global_index(r, [F.col("metric_value").desc(), F.col("run_name")], "rank", base=1)
    return ranked.select("run_name", "run_id", "metric_value", "params", "metrics",
                         F.col("rank").cast("int").alias("rank"))


def best_run(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("rank") == 1)


def _newest_first(runs: DataFrame) -> DataFrame:
    return segmented_rank(runs, ["experiment"], [F.col("start_time").desc(), F.col("run_id").desc()], "_r")


def retain_last_runs(runs: DataFrame, keep_last_n: int = 10) -> DataFrame:
    """H5: the delete set — runs older than the newest ``keep_last_n`` of
    their experiment."""
    return _newest_first(runs).where(F.col("_r") > keep_last_n).select("experiment", "run_id", "start_time")


def remove_old_runs(spark: SparkSession, path: str, keep_last_n: int = 10) -> None:
    """H5 on the stored log: the newest ``keep_last_n`` runs of every experiment
    are written as a new version, and then the pointer moves to it. A job that
    fails before leaves the old version current. One writer at a time: runs
    appended meanwhile stay in the old version."""
    if _current(spark, path) is None:
        return
    folder = f"runs-{uuid.uuid4().hex}"
    kept = _newest_first(read_runs(spark, path)).where(F.col("_r") <= keep_last_n).drop("_r")
    kept.write.parquet(f"{path}/{folder}")
    newest = spark.read.schema("version long").parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    _point(spark, path, newest + 1, folder)


def model_versions(registrations: DataFrame) -> DataFrame:
    """H6: version = 1, 2, ... per model name in registration order (a
    requested version number is ignored, as in the reference)."""
    v = segmented_rank(registrations, ["name"], [F.col("ts"), F.col("run_id")], "version")
    return v.withColumn("version", F.col("version").cast("int"))


def latest_stage_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """H7: latest version per (name, stage); optionally one stage."""
    v = versions if stage is None else versions.where(F.col("stage") == stage)
    return v.groupBy("name", "stage").agg(F.max("version").alias("version"),
                                          F.max_by("run_id", "version").alias("run_id"))


def registered_model(versions: DataFrame, name: str, stage: str = "Production") -> DataFrame:
    """H7: the latest version of ``name`` in ``stage``, one row; a ValueError
    when there is none."""
    found = latest_stage_version(versions.where(F.col("name") == name), stage)
    if found.isEmpty():
        raise ValueError(f"No model found in stage: {stage}")
    return found


def events_as_runs(events: DataFrame) -> DataFrame:
    """Run log derived from ``events``: experiment = event type, run = event,
    name = user, metric f1 = value (missing for ``error`` events)."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_type").alias("experiment"), F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("run_name"),
        F.col("ts").alias("start_time"),
        prefixed(F.create_map(F.lit("k"), k), "m").alias("params"),
        F.when(F.col("event_type") == "error", F.create_map().cast("map<string,double>"))
         .otherwise(F.create_map(F.lit("f1"), F.col("value"))).alias("metrics"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("tags"),
        F.array(F.concat(F.lit("event-"), F.col("event_id").cast("string"))).alias("artifacts"))


def events_as_registrations(events: DataFrame) -> DataFrame:
    """Registry derived from ``events``: purchases and signups register a
    version of model ``model_<type>``; stage from the value."""
    stage = F.element_at(F.array(F.lit("Staging"), F.lit("Production"), F.lit("Archived")),
                         (F.pmod(F.floor("value"), F.lit(3)) + 1).cast("int"))
    return (events.where(F.col("event_type").isin("purchase", "signup"))
                  .select(F.concat(F.lit("model_"), F.col("event_type")).alias("name"),
                          F.col("event_id").cast("string").alias("run_id"), "ts", stage.alias("stage")))
