from pyspark.sql import functions as F

from conftest import SF001


def test_prepare_writes_everything_and_tracks_it(spark, tmpdir_path):
    from textlathe.operators import tracking
    from textlathe.plans.prepare import prepare
    d = (spark.read.parquet(f"{SF001}/documents.parquet")
              .join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id")
              .select("doc_id", F.col("text").alias("body"), F.col("quality").alias("y")))
    out = tmpdir_path + "/run"
    summary = {r.stage: r.value for r in prepare(spark, d, out, "docs", "body", "y").collect()}
    assert summary["raw_rows"] == d.count()
    assert summary["train_rows"] + summary["test_rows"] + summary["val_rows"] == summary["processed_rows"]
    # a second run with the same parameters stays in the same experiment
    prepare(spark, d, out + "2", "docs", "body", "y", log_path=out + "/tracking")
    log = spark.read.parquet(out + "/tracking")
    ix = tracking.experiment_index(log).collect()
    assert len(ix) == 1 and ix[0].exp_id == 0
    for slot in tracking.SLOTS:
        assert getattr(ix[0], slot) is not None
    feats = spark.read.parquet(out + "/features")
    assert {r.split for r in feats.select("split").distinct().collect()} <= {"train", "test", "val"}


def test_row_ids_are_unique_and_stable(spark):
    from textlathe.operators.cleaning import with_row_id
    rows = [("a", "pos"), ("a", "pos"), ("b", None), (None, None), (None, None), ("a", "neg")]
    df = spark.createDataFrame(rows, "text string, sentiment string")
    ids = [sorted(r.doc_id for r in with_row_id(df.repartition(n), "doc_id", p).collect()) for n, p in ((1, 1), (4, 50))]
    assert ids[0] == ids[1] and len(set(ids[0])) == len(rows)
    assert with_row_id(df.limit(0)).count() == 0


def test_path_to_summary_without_an_id(spark, tmpdir_path):
    from textlathe.operators import tracking
    from textlathe.plans.prepare import load_and_validate, load_process_save, prepare_path
    path = f"{tmpdir_path}/my file.csv"
    with open(path, "w") as f:
        f.write("review,label\n")
        for i in range(60):
            f.write(f'"great movies and {"good" if i % 2 else "bad"} stories number{"x" * (i % 5)}",{"pos" if i % 2 else "neg"}\n')
    got = {r.stage: r.value for r in prepare_path(spark, path, f"{tmpdir_path}/out", "d", "review", "label").collect()}
    assert got["raw_rows"] == got["processed_rows"] == 60
    assert got["train_rows"] + got["test_rows"] + got["val_rows"] == 60 and got["num_features"] > 0
    index = tracking.experiment_index(spark.read.parquet(f"{tmpdir_path}/out/tracking"))
    import json
    stored = json.loads(index.first().feature_params)
    assert stored["train_features_shape"] == [got["train_rows"], got["num_features"]]
    saved = load_process_save(spark, path, f"{tmpdir_path}/saved", "review", "label")
    assert saved.count() == 60 and saved.first().cleaned_text.startswith("great movie")
    spark.createDataFrame([("good text here", "good text", i % 2) for i in range(40)],
                          "text string, cleaned_text string, sentiment int") \
        .write.option("header", True).csv(f"{tmpdir_path}/processed.csv")
    assert load_and_validate(spark, f"{tmpdir_path}/processed.csv", "csv").count() == 40


def test_null_labels_are_an_error_in_fit(spark):
    import pytest
    from textlathe.operators import features
    df = spark.createDataFrame([(1, "red blue", 1), (2, "red green", None)], "doc_id long, cleaned_text string, sentiment int")
    with pytest.raises(ValueError, match="nulls"):
        features.fit(df)
