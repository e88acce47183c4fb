"""Work that must not grow with files, folds or partitions."""
from pyspark.sql import functions as F

from textlathe.functions import constants as K
from textlathe.functions import text as T

ODD = ["Ünïcode wörds ÀÉ naïve İstanbul", "plain ascii The words_1 2x", "", "   \t", "  ", " " * 90 + "late",
       " " * 90, "children geese lens mice oxen women the buses", "no-break space\x1cfs ́combining", None,
       "cannot gimme gonna gotta lemme wanna", "tail‍join x́y"]


def counted(monkeypatch, module, name):
    calls, real = [], getattr(module, name)

    def spy(*a, **k):
        calls.append(1)
        return real(*a, **k)
    monkeypatch.setattr(module, name, spy)
    return calls


def small_docs(spark, n=30):
    texts = ["red apple tart", "green apple pie", "red wine glass", "green tea cup", "apple tea mix", "zebra zebra zebra"]
    return spark.createDataFrame([(i, texts[i % 6] + f" w{i % 4}", i % 2, i % 3) for i in range(n)],
                                 "doc_id int, cleaned_text string, sentiment int, fold int")


def test_short_cuts_of_text_functions_change_no_value(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "text string").coalesce(1)
    low, sw = F.lower("text"), K.CLEANING_STOPWORDS
    plain = {
        "blank": ~low.rlike(K.J_NON_WS_PATTERN),
        "tokens": F.filter(F.regexp_extract_all(T.strip_accents(low), F.lit(T.WORD_PATTERN), 0), lambda t: ~t.isin(*sw)),
        "clean": T.remove_stopwords(T.tokenize(T.strip_special(low)))}
    now = {"blank": T.is_blank("text"), "tokens": T.vectorizer_tokens("text"), "clean": T.clean_tokens("text", lemmas=False)}
    for name in plain:
        rows = df.select(plain[name].alias("a"), now[name].alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows], name
    words = spark.createDataFrame([(f, m) for f, m in K.LEMMA_EXCEPTIONS], "form string, lemma string")
    assert words.where(T.lemma_rule(F.col("form")) != F.col("lemma")).count() == 0


def test_label_report_does_not_lowercase_whole_texts(spark):
    from textlathe.operators.cleaning import apply_cleaning, label_report
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(ODD)], "text string, sentiment int")
    report = label_report(df)
    assert "lower(" not in report._jdf.queryExecution().executedPlan().toString()
    r = report.agg(F.sum("rows_in"), F.sum("dropped_null"), F.sum("dropped_blank"), F.sum("rows_out")).first()
    assert tuple(r) == (12, 1, 4, 7) and apply_cleaning(df).count() == 7


def test_chi2_fit_caches_no_weights(spark, monkeypatch):
    from textlathe.operators import features as FX
    seen, real = [], FX.chi2_scores

    def spy(weights, *a):
        seen.append(weights.storageLevel.useMemory)
        return real(weights, *a)
    monkeypatch.setattr(FX, "chi2_scores", spy)
    FX.fit(small_docs(spark))
    assert seen == [False]


def test_stream_takes_files_by_cores_and_reads_the_vocabulary_once(spark, tmpdir_path, monkeypatch):
    import os
    from textlathe.operators import features as FX
    from textlathe.streaming import featurize as S
    docs = small_docs(spark, 48).select(F.col("doc_id").cast("long"), F.concat(F.lit("The "), "cleaned_text").alias("text"), "sentiment")
    docs.select("doc_id", "text").repartition(12).write.parquet(f"{tmpdir_path}/documents.parquet")
    model = FX.fit(docs.withColumn("cleaned_text", T.clean_text("text")))
    calls, parts = counted(monkeypatch, FX, "held_vocabulary"), []

    def prepare(batch):
        out = S.clean_batch(batch.coalesce(1))
        parts.append(out.rdd.getNumPartitions())
        return out
    out = f"{tmpdir_path}/out"
    run = S.featurize_batches(model, "doc_id", out, "", prepare)
    (S.document_stream(spark, tmpdir_path).writeStream.foreachBatch(run).option("checkpointLocation", f"{tmpdir_path}/ck")
      .trigger(availableNow=True).start().awaitTermination())
    batches = [d for d in os.listdir(out) if d.startswith("batch_id=")]
    assert len(batches) == -(-12 // spark.sparkContext.defaultParallelism) and len(calls) == 1
    assert set(parts) == {spark.sparkContext.defaultParallelism}
    want = model.transform(docs.withColumn("cleaned_text", T.clean_text("text")), "doc_id")
    key = lambda df: sorted((r.doc_id, r.sel_idx, r.term, r.value) for r in df.collect())
    assert key(spark.read.parquet(out)) == key(want)


def test_fit_table_has_partitions_by_rows(spark, monkeypatch):
    from textlathe.operators import training as TR
    monkeypatch.setattr(TR, "ROWS_A_PARTITION", 40)
    rows = spark.range(100).repartition(16)
    for n in (None, 100):
        t = TR.fit_table(rows, n=n)
        assert t.rdd.getNumPartitions() == 3 and sorted(r.id for r in t.collect()) == list(range(100))


def test_registered_fits_count_n_grams_once(spark, monkeypatch):
    from textlathe.operators import features as FX
    from textlathe.plans import catalog
    calls = counted(monkeypatch, FX, "grams")
    d = catalog._ml_data(spark, "/root/testdata/sf0.001")
    assert len(calls) == 1 and d.columns == ["doc_id", "split", "label", "features", "fold"]


def test_folds_share_one_count_of_n_grams_and_terms(spark, monkeypatch):
    from textlathe.operators import features as FX
    from textlathe.operators import training as TR
    docs = small_docs(spark)
    grams, passes = counted(monkeypatch, FX, "grams"), counted(monkeypatch, FX, "exploded_terms")
    TR.fold_vectors(docs, num_folds=3)
    assert len(grams) == 1 and len(passes) == 1
    terms = FX.doc_terms(docs, "cleaned_text", FX.LIVE_CONFIG, ["doc_id", "fold"])
    stats = TR.fold_statistics(terms, "fold", 3)
    for f in range(3):
        want = FX.term_statistics(terms.where(F.col("fold") != f))
        assert sorted(map(tuple, TR.training_statistics(stats, f).collect())) == sorted(map(tuple, want.collect()))


def fold_rows(folds):
    return [[sorted((r.label, r.features.size, *(round(x, 9) for x in r.features.toArray())) for r in side.collect())
             for side in fold] for fold in folds]


def test_folds_read_the_n_grams_of_their_vocabularies_alone(spark, monkeypatch):
    from textlathe.operators import features as FX
    from textlathe.operators import training as TR
    again = [counted(monkeypatch, FX, name) for name in ("counted_grams", "tfidf_weights")]
    (train, _), *_ = TR.fold_vectors(small_docs(spark), num_folds=3)
    assert train.count() == 20 and again == [[], []]


def test_fold_vocabularies_are_whole_when_few_n_grams_are_tried_first(spark, monkeypatch):
    from dataclasses import replace
    from textlathe.operators import features as FX
    from textlathe.operators import training as TR
    # "rare" is frequent in fold 0 alone, "all" is in every row, null and empty texts have no n-gram
    docs = small_docs(spark).select("doc_id", "sentiment", "fold", F.concat(
        F.lit("all "), "cleaned_text", F.when(F.col("fold") == 0, F.lit(" rare rare rare")).otherwise("")).alias("cleaned_text"))
    docs = docs.unionByName(spark.createDataFrame([(90, 0, 0, None), (91, 1, 1, "")], docs.schema))
    for cfg in (replace(FX.LIVE_CONFIG, max_features=4, chi2_k=3, max_df=0.9),
                replace(FX.LIVE_CONFIG, max_features=9, min_df=3, use_chi2=False)):
        want = []
        for fold in range(3):
            model = FX.fit(docs.where(F.col("fold") != fold), cfg=cfg)
            rows = docs.select("doc_id", F.col("sentiment").cast("double").alias("label"), "fold").join(
                FX.feature_vectors(model, docs, "doc_id"), "doc_id")
            want.append((rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)))
        want = fold_rows(want)
        with monkeypatch.context() as m:
            m.setattr(TR, "CANDIDATES_A_FEATURE", 1)
            tries = counted(m, TR, "frequent_grams")
            assert fold_rows(TR.fold_vectors(docs, num_folds=3, cfg=cfg)) == want and len(tries) > 1
            m.setattr(FX, "VOCABULARY_TERMS", 0)
            assert TR.fold_counts(FX.grams(docs, "cleaned_text", cfg), ["doc_id"], "fold", 3, cfg) is None
            assert fold_rows(TR.fold_vectors(docs, num_folds=3, cfg=cfg)) == want
