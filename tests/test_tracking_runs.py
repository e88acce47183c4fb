import datetime as dt
import json

from pyspark.sql import functions as F

from textlathe.operators import joins, runs, tracking

P0 = json.dumps({"train_size": 0.7, "test_size": 0.2, "val_size": 0.1, "random_state": 69})
P1 = json.dumps({"train_size": 0.7, "test_size": 0.2, "val_size": 0.1, "random_state": 1})


def test_experiment_numbering(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [
        # dataset a: params change before any record -> same experiment
        ("a", 1, "processed_data_file", "p1", P1),
        ("a", 2, "split_params", P0, P0),
        ("a", 3, "train_split", "t1", P0),      # same params -> same exp
        ("a", 4, "train_split", "t2", P1),      # recorded P0 != current P1 -> exp 1
        ("a", 5, "test_split", "t3", P0),       # new exp has no record -> stays 1
        ("a", 6, "split_params", "not json", P0),
        ("a", 7, "val_split", "v", P0),         # unparsable -> exp 2
        ("a", 8, "val_split", "v2", P0),        # cleared -> stays 2
    ]
    log = spark.createDataFrame([(d, s, t + dt.timedelta(seconds=s), a, v, p) for d, s, a, v, p in rows],
                                tracking.LOG_SCHEMA)
    for parts in (1, 3, 200):
        ids = {r.seq: r.exp_id for r in tracking.experiment_ids(log, parts).collect()}
        assert ids == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 7: 2, 8: 2}
    ix = {r.exp_id: r for r in tracking.experiment_index(log).collect()}
    assert ix[0].split_params == P0 and ix[0].train_split == "t1"
    assert ix[1].train_split == "t2" and ix[1].split_params == "not json"
    assert ix[2].val_split == "v2"


def test_segmented_rank_with_hot_key(spark):
    rows = [("hot", i) for i in range(500)] + [("cold%d" % (i % 7), i) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o long")
    r = joins.segmented_rank(df, ["k"], [F.col("o")], "rk", num_partitions=9)
    got = {(x.k, x.o): x.rk for x in r.collect()}
    exp = {}
    for k in {k for k, _ in rows}:
        for pos, o in enumerate(sorted(o for kk, o in rows if kk == k), 1):
            exp[(k, o)] = pos
    assert got == exp


def test_compare_runs_missing_metric_and_equal_names(spark):
    t = dt.datetime(2024, 1, 1)
    data = [("e", "r1", "same", t, {}, {"f1": 0.5}, {"t": "x"}, ["a", "b"]),
            ("e", "r2", "same", t + dt.timedelta(1), {}, {"f1": 0.9}, None, None),
            ("e", "r3", "other", t, {}, {}, {}, [])]
    df = spark.createDataFrame(data, runs.RUN_SCHEMA)
    c = {r.run_name: r for r in runs.compare_runs(df, "e").collect()}
    assert c["same"].run_id == "r1" and c["same"].metric_value == 0.5
    assert c["other"].metric_value == 0.0
    assert runs.best_run(runs.compare_runs(df, "e")).first().run_name == "same"
    assert {r.run_id for r in runs.retain_last_runs(df, 1).collect()} == {"r1", "r3"}
    assert sorted(tuple(r) for r in runs.run_log_long(df).where("run_id = 'r1'").collect()) == [
        ("r1", "artifact", "0", "a"), ("r1", "artifact", "1", "b"), ("r1", "metric", "f1", "0.5"), ("r1", "tag", "t", "x")]


def test_segmented_running_matches_windows(spark):
    from pyspark.sql import Window
    rows = [("hot", i, i % 3 if i % 5 else None) for i in range(400)] + [("c%d" % (i % 4), i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    out = joins.segmented_running(df, ["k"], [F.col("o")], sums={"s": F.coalesce("v", F.lit(0))},
                                  lasts={"l": F.col("v")}, inclusive=False, num_partitions=7)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.select("k", "o", F.coalesce(F.sum(F.coalesce("v", F.lit(0))).over(w), F.lit(0)).alias("s"),
                    F.last("v", ignorenulls=True).over(w).alias("l"))
    assert sorted(map(tuple, out.select("k", "o", "s", "l").collect())) == sorted(map(tuple, exp.collect()))


def test_null_keys_keep_every_row(spark):
    rows = [(None, i) for i in range(30)] + [("a", i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, o long")
    for parts in (1, 200):
        ranked = joins.segmented_rank(df, ["k"], [F.col("o")], "rk", num_partitions=parts)
        assert sorted((r.k or "", r.o, r.rk) for r in ranked.collect()) == sorted((k or "", o, o + 1) for k, o in rows)
        run = joins.segmented_running(df, ["k"], [F.col("o")], sums={"s": F.col("o")}, num_partitions=parts)
        assert sorted((r.k or "", r.o, r.s) for r in run.collect()) == sorted((k or "", o, o * (o + 1) // 2) for k, o in rows)


def test_null_split_params_clear_the_record(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", 1, "split_params", P0, P0), ("a", 2, "split_params", None, P0), ("a", 3, "train_split", "t", P1),
            (None, 1, "split_params", P0, P0), (None, 2, "train_split", "t", P1)]
    log = spark.createDataFrame([(d, s, t + dt.timedelta(seconds=s), a, v, p) for d, s, a, v, p in rows],
                                tracking.LOG_SCHEMA)
    for parts in (1, 200):
        got = {(r.dataset, r.seq): r.exp_id for r in tracking.experiment_ids(log, parts).collect()}
        assert got == {("a", 1): 0, ("a", 2): 0, ("a", 3): 0, (None, 1): 0, (None, 2): 1}


def test_rankings_over_all_rows_never_use_one_task(spark):
    df = spark.createDataFrame([("e", f"r{i}", f"n{i}", dt.datetime(2024, 1, 1), {"a": "1"}, {"f1": i / 9.0}, None, None)
                                for i in range(9)], runs.RUN_SCHEMA)
    compared = runs.compare_runs(df, "e")
    assert [r.run_id for r in compared.orderBy("rank").collect()] == [f"r{i}" for i in reversed(range(9))]
    assert compared.first().params == {"a": "1"}
    assert [r.experiment_id for r in runs.experiments(df).collect()] == [0]


def test_document_stream_reads_part_files_and_single_files(spark, tmpdir_path):
    from textlathe.streaming import featurize
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.repartition(3).write.parquet(f"{tmpdir_path}/many/documents.parquet")
    for k, folder in enumerate((f"{tmpdir_path}/many", "/root/testdata/sf0.001")):
        out = f"{tmpdir_path}/out{k}"
        featurize.run_available(spark, featurize.document_stream(spark, folder), out, f"{tmpdir_path}/ck{k}")
        assert spark.read.parquet(out).count() == docs.count()


def run(experiment, i, artifacts=None):
    return (experiment, f"r{i}", f"n{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), {"a": "1"}, {"f1": 0.5}, None, artifacts)


def test_removed_runs_are_gone_after_reading_back(spark, tmpdir_path):
    p = f"{tmpdir_path}/log"
    runs.remove_old_runs(spark, p, 2)  # no log yet
    assert runs.read_runs(spark, p).count() == 0
    runs.log_runs(spark.createDataFrame([run("a", i) for i in range(5)] + [run(None, i) for i in range(3)], runs.RUN_SCHEMA), p)
    runs.remove_old_runs(spark, p, 2)
    left = {(r.experiment, r.run_id) for r in runs.read_runs(spark, p).collect()}
    assert left == {("a", "r4"), ("a", "r3"), (None, "r2"), (None, "r1")}
    runs.log_runs(spark.createDataFrame([run("a", 9)], runs.RUN_SCHEMA), p)
    runs.remove_old_runs(spark, p, 1)
    back = runs.read_runs(spark, p).collect()
    assert {(r.experiment, r.run_id) for r in back} == {("a", "r9"), (None, "r2")}
    assert back[0].params == {"a": "1"}


def test_missing_artifact_files_are_not_logged(spark, tmpdir_path):
    base = f"{tmpdir_path}/files one+two"
    spark.range(3).write.parquet(base + "/model")
    part = next(r.path for r in runs.artifact_listing(spark, base).collect() if r.path.endswith(".parquet"))
    log = runs.run_log_long(spark.createDataFrame(
        [run("a", 1, [base + "/model", base + "/gone", part, None])], runs.RUN_SCHEMA), runs.artifact_listing(spark, base))
    rows = {(r.kind, r.key, r.value) for r in log.collect()}
    assert rows == {("param", "a", "1"), ("metric", "f1", "0.5"), ("artifact", "0", base + "/model"), ("artifact", "2", part)}
    assert runs.artifact_listing(spark, base + "/none").count() == 0


def test_new_experiments_carry_tags_and_missing_stages_raise(spark):
    import pytest
    have = spark.createDataFrame([("a",)], "experiment string")
    new = runs.get_or_create(have, spark.createDataFrame([("a",), ("b",), ("b",)], "experiment string"), {"team": "x"})
    assert [(r.experiment, r.tags) for r in new.collect()] == [("b", {"team": "x"})]
    v = spark.createDataFrame([("m", "r1", "Staging", 1), ("m", "r2", "Staging", 2)],
                              "name string, run_id string, stage string, version int")
    assert runs.registered_model(v, "m", "Staging").first().run_id == "r2"
    with pytest.raises(ValueError):
        runs.registered_model(v, "m", "Production")
