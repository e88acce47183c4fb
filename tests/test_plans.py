"""Plan-shape checks over every registered query (sf0.001): no cartesian
products or nested-loop joins, and every query runs."""

import pytest

from conftest import SF001

SKIP_SLOW = {"train_lr", "train_rf", "train_svc", "train_gbt", "cross_validate", "grid_search", "random_search"}


def test_no_cartesian_plans(spark):
    import __spark_entry__ as E
    bad = []
    for name, fn in sorted(E.queries().items()):
        if name in SKIP_SLOW:
            continue
        df = fn(spark, SF001)
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
        df.limit(1).collect()
    assert bad == []


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scale_shapes_of_split_and_transform(spark):
    """The split and the feature transform never gather the data into one
    partition; the bounded vocabulary is broadcast; the scan reads only the
    needed columns."""
    from dataclasses import replace

    from textlathe.operators import features as FX
    from textlathe.operators.split import stratified_split
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", "lang")
    from textlathe.functions import text as T
    d = docs.select("doc_id", F_col("lang").alias("sentiment"), T.clean_text("text").alias("cleaned_text"))
    s = stratified_split(d)
    assert "SinglePartition" not in _plan(s)
    m = FX.fit(d, cfg=replace(FX.LIVE_CONFIG, chi2_k=20))
    t = m.transform(d, "doc_id")
    p = _plan(t)
    assert "SinglePartition" not in p
    assert "BroadcastHashJoin" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p or "ReadSchema: struct<doc_id:bigint,text:string>" in p


def F_col(name):
    from pyspark.sql import functions as F
    return F.col(name)
