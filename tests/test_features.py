import math
from collections import Counter
from dataclasses import replace

from textlathe.operators import features as FX

DOCS = [
    (1, "love product amazing quality", 1),
    (2, "terrible quality waste money", 0),
    (3, "good value price excellent", 1),
    (4, "worst experience ever bad", 0),
]


def brute(docs, max_df=0.95):
    n = len(docs)
    grams = {}
    for i, t, _ in docs:
        tk = t.split()
        grams[i] = Counter(tk + [a + " " + b for a, b in zip(tk, tk[1:])])
    df = Counter(g for c in grams.values() for g in c)
    vocab = sorted(t for t, d in df.items() if d <= max_df * n)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in vocab}
    vals = {}
    for i, c in grams.items():
        w = {t: c[t] * idf[t] for t in c if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        vals[i] = {t: x / norm for t, x in w.items()}
    labels = {i: y for i, _, y in docs}
    classes = sorted(set(labels.values()))
    p = {c: sum(1 for y in labels.values() if y == c) / n for c in classes}
    chi = {}
    for t in vocab:
        F = sum(v.get(t, 0.0) for v in vals.values())
        s = 0.0
        for c in classes:
            o = sum(v.get(t, 0.0) for i, v in vals.items() if labels[i] == c)
            e = p[c] * F
            s += (o - e) ** 2 / e
        chi[t] = s
    return vocab, idf, vals, chi


def frame(spark):
    return spark.createDataFrame(DOCS, "doc_id long, cleaned_text string, sentiment int")


def test_tfidf_and_chi2_match_brute_force(spark):
    vocab, idf, vals, chi = brute(DOCS)
    cfg = replace(FX.LIVE_CONFIG, chi2_k=10 ** 6)
    m = FX.fit(frame(spark), cfg=cfg)
    t = {r.term: r for r in m.table.collect()}
    assert sorted(t) == vocab
    for term in vocab:
        assert abs(t[term].idf - idf[term]) < 1e-12
        assert abs(t[term].score - chi[term]) < 1e-9
    out = m.transform(frame(spark), "doc_id").collect()
    got = {(r.doc_id, r.term): r.value for r in out}
    exp = {(i, term): v for i, d in vals.items() for term, v in d.items()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-12 for k in exp)


def test_select_k_best_ties_prefer_later_terms(spark):
    _, _, _, chi = brute(DOCS)
    m = FX.fit(frame(spark), cfg=replace(FX.LIVE_CONFIG, chi2_k=3))
    names = [r.term for r in m.feature_names().collect()]
    assert len(names) == 3
    # many terms tie at the best score: among them the alphabetically
    # last ones are kept (a stable sort ascending, take the last k)
    best = sorted(sorted(chi), key=lambda t: round(chi[t], 9))[-3:]
    assert len([t for t in chi if round(chi[t], 9) == round(chi[best[-1]], 9)]) > 3
    assert names == sorted(best)


def test_transform_unseen_ignores_unknown_terms(spark):
    m = FX.fit(frame(spark), cfg=replace(FX.LIVE_CONFIG, use_chi2=False))
    new = spark.createDataFrame([(9, "zebra quality"), (10, "nothing known")], "doc_id long, cleaned_text string")
    out = m.transform(new, "doc_id").collect()
    assert {(r.doc_id, r.term) for r in out} == {(9, "quality")}
    assert abs(out[0].value - 1.0) < 1e-12


def test_model_roundtrip(spark, tmpdir_path):
    m = FX.fit(frame(spark))
    m.save(tmpdir_path + "/m")
    m2 = FX.FeatureModel.load(spark, tmpdir_path + "/m")
    a = sorted(map(tuple, m.transform(frame(spark), "doc_id").collect()))
    b = sorted(map(tuple, m2.transform(frame(spark), "doc_id").collect()))
    assert a == b


def test_min_df_prunes_everything_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        FX.fit(frame(spark), cfg=replace(FX.LIVE_CONFIG, min_df=5, max_df=10))


def test_row_local_and_joined_weights_are_equal(spark, monkeypatch):
    new = spark.createDataFrame([(8, None), (9, "zebra quality quality money"), (10, "nothing known")],
                                "doc_id long, cleaned_text string")
    for cfg in (replace(FX.LIVE_CONFIG, use_chi2=False), replace(FX.LIVE_CONFIG, chi2_k=5)):
        m = FX.fit(frame(spark), cfg=cfg)
        every = frame(spark).select("doc_id", "cleaned_text").union(new)
        results = []
        for terms in (FX.VOCABULARY_TERMS, 0):  # held by the workers, then joined
            monkeypatch.setattr(FX, "VOCABULARY_TERMS", terms)
            out = m.transform(every, "doc_id", zeros=True)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("hashpartitioning(doc_id" in plan) == (terms == 0)
            rows = out.collect()
            assert {r.doc_id for r in rows} == {1, 2, 3, 4, 8, 9, 10}
            assert [r.term for r in rows if r.doc_id in (8, 10)] == [None, None]
            plain = m.transform(every, "doc_id").collect()
            assert len(plain) == sum(r.term is not None for r in rows)
            results.append({(r.doc_id, r.sel_idx, r.term): r.value for r in rows})
            monkeypatch.undo()
        a, b = results
        assert a.keys() == b.keys()
        assert all(a[k] == b[k] or abs(a[k] - b[k]) < 1e-12 for k in a)


def test_mutual_information_matches_brute_force(spark, monkeypatch):
    docs = [(i, t, i % 3) for i, t in enumerate(
        ["red green", "red blue", "blue blue green", "red red", "green", "blue red green", "red green", "black"])]
    _, _, vals, _ = brute(docs, max_df=1.0)
    n, label = len(docs), {i: y for i, _, y in docs}

    def score(term):
        cell = Counter((round(vals[i].get(term, 0.0), 9), label[i]) for i in vals)
        by_v, by_y = Counter(), Counter()
        for (v, y), c in cell.items():
            by_v[v] += c
            by_y[y] += c
        return max(0.0, sum(c / n * math.log(n * c / (by_v[v] * by_y[y])) for (v, y), c in cell.items()))
    df = spark.createDataFrame(docs, "doc_id long, cleaned_text string, sentiment int")
    cfg = replace(FX.LIVE_CONFIG, use_chi2=False, use_mutual_info=True, max_df=1.0)
    for width in (FX.MI_CLASSES, 1, 2):  # classes side by side, and in blocks
        monkeypatch.setattr(FX, "MI_CLASSES", width)
        got = {r.term: r.score for r in FX.fit(df, cfg=cfg).table.collect()}
        assert len(got) > 5
        assert all(abs(got[t] - score(t)) < 1e-9 for t in got)
