from dataclasses import replace

from pyspark.sql import functions as F

from textlathe.operators import cleaning, features as FX, labels, quality


def test_lexicon_lemmas_override_rules(spark):
    df = spark.createDataFrame([(1, ["geese", "cats", "houses"]), (2, [])], "doc_id long, tk array<string>")
    lex = spark.createDataFrame([("geese", "goose"), ("houses", "house")], "form string, lemma string")
    out = {r.doc_id: r.lemmas for r in cleaning.lemmatize_with_lexicon(df, "doc_id", "tk", lex, 2).collect()}
    assert out == {1: ["goose", "cat", "house"], 2: []}


def test_feature_vectors_match_long_form(spark):
    docs = spark.createDataFrame([(1, "good value good price", 1), (2, "bad value", 0), (3, "good", 1), (4, "worse bad", 0)],
                                 "doc_id long, cleaned_text string, sentiment int")
    m = FX.fit(docs, cfg=replace(FX.LIVE_CONFIG, chi2_k=3))
    long = {(r.doc_id, r.sel_idx): r.value for r in m.transform(docs, "doc_id").collect()}
    vec = {r.doc_id: r.features for r in FX.feature_vectors(m, docs, "doc_id").collect()}
    assert set(vec) == {1, 2, 3, 4}
    for d, v in vec.items():
        assert v.size == 3
        for i in range(3):
            assert abs(v[i] - long.get((d, i), 0.0)) < 1e-12


def test_quality_report_and_label_mapping(spark):
    df = spark.createDataFrame([(1, "short", 0), (2, "a long enough text", 1), (3, None, 2), (4, "x" * 1200, None)],
                               "doc_id long, text string, sentiment int")
    r = {x.check: x for x in quality.quality_report(df, required=("text", "sentiment")).collect()}
    assert r["label_values"].value == 2.0 and not r["label_values"].passed
    assert abs(r["missing_ratio"].value - 2 / 12) < 1e-12
    assert r["short_texts"].value == 1.0 and r["long_texts"].value == 1.0
    m = labels.label_mapping(spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "sentiment string"))
    assert sorted(map(tuple, m.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    applied = labels.apply_label_mapping(spark.createDataFrame([("a",), ("z",), (None,)], "sentiment string"), m)
    assert sorted(r.sentiment for r in applied.collect()) == [0, 1, 1]
    only = spark.createDataFrame([("z",), (None,)], "sentiment string")
    assert [r.sentiment for r in labels.apply_label_mapping(only, m).collect()] == [0, 0]


def test_label_report_sums_to_the_cleaning_report(spark):
    df = spark.createDataFrame([("a b", "x"), (" ", "x"), (None, "x"), ("c", None), ("d", "y")], "text string, sentiment string")
    per = {r.sentiment: tuple(r)[1:] for r in cleaning.label_report(df).collect()}
    assert per == {"x": (3, 1, 1, 1), None: (1, 1, 0, 0), "y": (1, 0, 0, 1)}
    assert tuple(cleaning.cleaning_report(df).first()) == tuple(sum(v) for v in zip(*per.values()))


def test_prepare_reads_its_input_twice(spark, tmpdir_path):
    from textlathe.plans.prepare import prepare
    reads = spark.sparkContext.accumulator(0)

    def seen(text):
        reads.add(1)
        return text
    words = ["good value", "bad price", "fine thing", "poor thing", "good price", " "]
    rows = [(i, words[i % 6], ("neg", "pos")[i % 2] if i % 7 else None) for i in range(84)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sentiment string")
    df = df.withColumn("text", F.udf(seen, "string").asNondeterministic()("text"))
    out = {r.stage: r.value for r in prepare(spark, df, tmpdir_path, "d").collect()}
    kept = sum(1 for _, t, y in rows if y and t.strip())
    assert (out["raw_rows"], out["processed_rows"]) == (84, kept)
    assert reads.value == 2 * 84
    got = {r.sentiment for r in spark.read.parquet(f"{tmpdir_path}/processed").select("sentiment").collect()}
    assert got == {0, 1}


def test_required_columns_default_and_raise(spark):
    import pytest
    df = spark.createDataFrame([("a text", 1)], "text string, sentiment int")
    r = quality.quality_report(df).first()
    assert (r.check, r.value, r.passed) == ("required_columns", 1.0, False)
    with pytest.raises(ValueError):
        quality.validate(df)


def test_declared_search_spaces_and_draws(spark):
    from textlathe.operators import training as TR
    assert {f: len(TR.grid(f)) for f in TR.MODEL_GRIDS} == {
        "logistic_regression": 6, "random_forest": 27, "svm": 3, "naive_bayes": 6, "gradient_boosting": 27}
    for family in TR.MODEL_GRIDS:
        TR.estimator(family, 100)
        TR.estimator(family, 100, **TR.grid(family)[-1])
    assert TR.estimator("gradient_boosting", 100).getMaxDepth() == 5
    assert len(TR.random_draws(TR.grid("gradient_boosting"))) == 27
    assert TR.random_draws(TR.grid("svm"), 2) == TR.random_draws(TR.grid("svm"), 2)


def test_cross_validation_scores_the_positive_class(spark):
    from pyspark.ml.linalg import Vectors
    from textlathe.operators import training as TR
    pred = spark.createDataFrame([(1.0, 1.0)] * 2 + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 96, "label double, prediction double")
    assert abs(TR.positive_f1(pred) - 2 / 3) < 1e-9
    rows = [(i % 3, float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(30)]
    data = spark.createDataFrame(rows, ["fold", "label", "features"])
    got = TR.cross_validate("logistic_regression", TR.grid("logistic_regression")[:2], data, num_folds=3)
    assert len(got) == 2 and all(len(x) == 3 and min(x) == 1.0 for x in got)


def test_vectors_of_a_large_vocabulary_are_the_row_local_ones(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "good value good price", 1), (2, "bad value", 0), (3, "good", 1), (4, "worse bad", 0),
                                  (5, "unseen", 1), (6, "", 0), (7, None, 0)], "doc_id long, cleaned_text string, sentiment int")
    m = FX.fit(docs.where("doc_id < 5"), cfg=replace(FX.LIVE_CONFIG, chi2_k=3))
    want = {r.doc_id: r.features for r in FX.feature_vectors(m, docs, "doc_id").collect()}
    monkeypatch.setattr(FX, "VOCABULARY_TERMS", 0)
    got = {r.doc_id: r.features for r in FX.feature_vectors(m, docs, "doc_id").collect()}
    assert set(got) == set(want) == set(range(1, 8))
    for d in want:
        assert got[d].size == want[d].size == 3
        assert all(abs(a - b) < 1e-12 for a, b in zip(got[d].toArray(), want[d].toArray()))
