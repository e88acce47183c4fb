import json


def test_repeated_lexicon_forms_give_one_lemma(spark):
    from textlathe.operators.cleaning import lemmatize_with_lexicon
    docs = spark.createDataFrame([(1, ["mice", "running", "quickly"])], "doc_id int, tokens array<string>")
    lexicon = spark.createDataFrame([("mice", "rodent"), ("mice", "mouse"), ("mice", "mouse"), (None, "x")],
                                    "form string, lemma string")
    assert lemmatize_with_lexicon(docs, "doc_id", "tokens", lexicon).first().lemmas == ["mouse", "running", "quickly"]


def test_stored_feature_settings_read_back():
    from textlathe.operators.features import FeatureConfig
    for cfg in (FeatureConfig(), FeatureConfig(stop_words=None, ngram_range=(1, 1), max_features=None),
                FeatureConfig(stop_words=("a", "the"))):
        assert FeatureConfig.from_json(cfg.to_json()) == cfg
    assert "the" in json.loads(FeatureConfig(stop_words=("a", "the")).to_json())["stop_words"]


def test_log_rows_are_appended_in_the_schema_of_the_log(spark, tmpdir_path):
    from textlathe.operators.tracking import LOG_SCHEMA, append_artifacts, append_log
    path = f"{tmpdir_path}/log"
    append_artifacts(spark, path, "d", [("train_split", "a")], "{}")
    append_log(spark.sql("SELECT 'e' AS dataset, 7 AS seq, current_timestamp() AS ts, 'x' AS artifact_type, "
                         "'v' AS value, null AS params, 1 AS more"), path)
    got = spark.read.parquet(path)
    assert got.columns == [c.split(" ")[0] for c in LOG_SCHEMA.split(", ")]
    assert sorted((r.dataset, r.value) for r in got.collect()) == [("d", "a"), ("e", "v")]


def test_raw_json_is_read_whole_in_every_form(spark, tmpdir_path):
    import os
    from textlathe.sources.readers import download_raw
    rows = [{"text": f"t{i}", "sentiment": "a"} for i in range(5)]
    forms = {"lines": "\n" + "\n".join(map(json.dumps, rows)), "array": json.dumps(rows), "indented": json.dumps(rows, indent=1),
             "empty": ""}
    for name, raw in forms.items():
        os.makedirs(f"{tmpdir_path}/{name}")
        with open(f"{tmpdir_path}/{name}/a.json", "w") as f:
            f.write(raw)
        got = download_raw(spark, f"{tmpdir_path}/{name}", "text string, sentiment string")
        assert sorted(r.text for r in got.collect()) == ([] if name == "empty" else [r["text"] for r in rows]), name
