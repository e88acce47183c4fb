"""Invariants and edge cases."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from textlathe.operators import features as FX
from textlathe.operators import split as SP

DOCS = [(1, "alpha beta gamma", 1), (2, "beta gamma delta", 0), (3, "gamma delta epsilon", 1),
        (4, "delta epsilon zeta", 0), (5, "alpha zeta", 1), (6, "beta epsilon", 0)]


def frame(spark):
    return spark.createDataFrame(DOCS, "doc_id long, cleaned_text string, sentiment int")


def test_rows_have_unit_norm_before_selection(spark):
    m = FX.fit(frame(spark), cfg=replace(FX.LIVE_CONFIG, use_chi2=False))
    norms = m.transform(frame(spark), "doc_id").groupBy("doc_id").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("n"))
    assert all(abs(r.n - 1.0) < 1e-12 for r in norms.collect())


def test_k_larger_than_vocabulary_keeps_all(spark):
    m = FX.fit(frame(spark), cfg=replace(FX.LIVE_CONFIG, chi2_k=10 ** 6))
    assert m.n_selected == m.n_terms
    assert m.table.where("selected").count() == m.n_terms


def test_vocabulary_has_no_test_only_term(spark):
    from textlathe.plans.prepare import features_for_splits
    df = spark.createDataFrame([(i, f"common word{i} shared group{i % 3}", i % 2) for i in range(40)],
                               "doc_id long, cleaned_text string, sentiment int")
    s = SP.stratified_split(df)
    feats, m = features_for_splits(s, cfg=replace(FX.LIVE_CONFIG, use_chi2=False))
    train_docs = {r.doc_id for r in s.where("split = 'train'").collect()}
    vocab = {r.term for r in m.table.collect()}
    only_elsewhere = {f"word{i}" for i in range(40) if i not in train_docs}
    assert not (vocab & only_elsewhere)
    assert feats.where("split <> 'train'").count() > 0


def test_empty_input_raises(spark):
    empty = spark.createDataFrame([], "doc_id long, cleaned_text string, sentiment int")
    with pytest.raises(ValueError):
        FX.fit(empty)


def test_stopword_only_document_gets_no_features(spark):
    from textlathe.functions import text as T
    df = spark.createDataFrame([(1, "the and of it"), (2, "alpha beta")], "doc_id long, text string")
    out = {r.doc_id: r.c for r in df.select("doc_id", T.clean_text("text").alias("c")).collect()}
    assert out == {1: "", 2: "alpha beta"}


def test_split_same_under_other_partition_counts(spark):
    df = spark.createDataFrame([(i, i % 4) for i in range(200)], "doc_id long, sentiment int")
    base = sorted(map(tuple, SP.stratified_split(df).collect()))
    for parts in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            assert sorted(map(tuple, SP.stratified_split(df.repartition(3)).select("doc_id", "sentiment", "split").collect())) == base
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
