"""Quality classifier, language model and the pipeline."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from textlathe.llm import catalog, lm, quality

SF = "/root/testdata/sf0.001"


def test_held_out_quality_is_predicted(spark):
    rows = catalog.QUERIES["op1_quality_neighbours"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = rows.merge(labels, on="doc_id").query("held_out")
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    assert ((rows.score >= 0.7) == (rows.predicted == 1)).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    assert (held.predicted == held.quality).mean() >= 0.95


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame([(i, "plain words here. " * 5, 1) for i in range(20)]
                                 + [(20 + i, "###$$$ " * 30, 1) for i in range(20)]
                                 + [(None, None, 1), (50, "", 1), (50, "", 1), (51, "long " * 300000, 1)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i < 20)) for i in range(40)] + [(3, None), (3, 7), (None, 1), (4, 1)],
                                   "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 44 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["doc_id"] < 20) for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(docs.limit(0), labels) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_vote_is_brute_force_nearest_neighbours():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(300, 8)).astype(np.float32)
    y /= np.linalg.norm(y, axis=1)[:, None]
    labels = rng.integers(0, 2, 200)
    m = quality.Model(np.arange(3), np.ones(3), np.ones((3, 8)), y[:200], labels, 9, 20.0)
    got = m.vote(y[200:])
    for q, s in zip(y[200:], got):
        c = y[:200] @ q
        near = np.argsort(-c)[:9]
        w = np.exp(20.0 * c[near].astype(float))
        assert s == pytest.approx((w * labels[near]).sum() / w.sum(), abs=1e-4)


TEXTS = [(1, "a b a b c"), (2, "A b"), (3, None), (4, ""), (5, "x y\tz\x0bx"), (6, "a b a b c"), (6, "a b a b c"),
         (None, "a q"), (7, "\u00c9\u2003\u00e9 b")]


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def test_base_scores_are_exact(spark):
    df = spark.createDataFrame(TEXTS, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS key")
    trains = ~quality.held_out("doc_id", parts=5, part=1)
    got = lm.fit_and_score(df, trains).collect()
    kept = [t for k, t in TEXTS if zlib.crc32(("" if k is None else str(k)).encode()) % 5 != 1]
    c = Counter(x for t in kept for x in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((k or 0, len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, round(sum(
        math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens(t)), 9)) for k, t in TEXTS)
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 9))
                  for r in got) == want
    assert all(r["score"] <= 0 for r in got)
    assert lm.fit_and_score(df.limit(0), trains).count() == 0
    alone = lm.score(df, lm.fit(df.limit(0))).collect()
    assert {(r["base_score"], r["score"], r["n_known"]) for r in alone} == {(0.0, 0.0, 0)}


def test_filter_never_undercounts_and_rarely_overcounts():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2 ** 63, 40000).astype(np.uint64)
    counts = rng.geometric(0.4, 40000) * rng.integers(1, 50, 40000)
    f = lm.LogBloom.build(keys, counts)
    got = f.levels(keys)
    assert (got >= lm.level(counts)).all() and (got > lm.level(counts)).mean() < 0.03
    assert (f.levels(rng.integers(0, 2 ** 63, 40000).astype(np.uint64)) > 0).mean() < 0.03
    assert (lm.level(np.array([1, 2, 3, 4])) == [1, 2, 3, 4]).all()


def test_segments_give_the_same_scores(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one = lm.score(df, lm.fit(df)).toPandas().set_index("doc_id").sort_index()
    monkeypatch.setattr(lm, "SLICE_BYTES", 20000)
    monkeypatch.setattr(lm, "SEGMENT_BYTES", 1000)
    model = lm.fit(df)
    assert model.slices > 8 and len(model.pairs) > 2
    many = lm.score(df, model).toPandas().set_index("doc_id").sort_index()
    assert np.allclose(one.base_score, many.base_score)
    assert np.abs(one.score / one.n_tokens - many.score / many.n_tokens).max() < 0.05  # false positives differ


def test_model_beats_the_base_on_held_out_text(spark):
    r = catalog.QUERIES["op8_log_bloom_lm"](spark, "/root/testdata/sf0.01").toPandas().query("held_out")
    assert r.score.sum() > r.base_score.sum()


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.keep_quality(spark, docs, SF)
    scored = {r["doc_id"]: r["predicted"] for r in catalog.QUERIES["op1_quality_neighbours"](spark, SF).collect()}
    assert good.columns == columns
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(k for k, p in scored.items() if p == 1)
    single = corpus_pipeline.drop_near_copies(spark, docs, SF)
    groups = catalog.QUERIES["op7_simhash_groups"](spark, SF).collect()
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({r["component_id"] for r in groups})
    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in catalog.QUERIES["op6_curriculum_mix"](spark, SF).collect() if r["size"]}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and times == Counter({k: n for k, n in taken.items() if n})
    ids = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert ids == {r["doc_id"]: r["n_tokens"] for r in catalog.QUERIES["op9_bpe_transducer"](spark, SF).collect()}
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {r["doc_id"] for r in out.select("doc_id").collect()} <= set(taken)


def test_pipeline_on_an_empty_table_and_clashing_columns(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "1 AS size", "2 AS score", "3 AS row_id", "4 AS text_")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    for name, stage in corpus_pipeline.STAGES[:3]:
        got = stage(spark, docs.limit(40), SF)
        assert got.columns == docs.columns and {(r["size"], r["score"], r["row_id"]) for r in got.collect()} == {(1, 2, 3)}


def test_pipeline_without_usable_labels_raises(spark, tmp_path):
    import corpus_pipeline
    docs = spark.createDataFrame([(i, "clean words here. " * 5) for i in range(8)], "doc_id long, text string")
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    for k, labels in enumerate(([], [(900, 1)], [(held, 1)], [(1, None), (2, 7)])):
        spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        with pytest.raises(ValueError, match="label"):
            corpus_pipeline.keep_quality(spark, docs, f"{tmp_path}/{k}")
    assert corpus_pipeline.keep_quality(spark, docs.limit(0), f"{tmp_path}/0").count() == 0
