import json

SF001 = "/root/testdata/sf0.001"


SMALL = {
    "logistic_regression": {"C": (1.0,), "max_iter": (1, 50)},
    "random_forest": {"n_estimators": (2, 5), "max_depth": (None,), "min_samples_leaf": (1,)},
    "svm": {"C": (1.0,)},
    "naive_bayes": {"alpha": (1.0,), "fit_prior": (True, False)},
    "gradient_boosting": {"n_estimators": (1, 3), "learning_rate": (0.1,), "max_depth": (2,)},
}


def test_search_space_and_shared_fits_cover_every_candidate():
    from textlathe.operators import training as TR
    space = TR.search_space()
    assert len(space) == 69 and [f for f, _ in space] == sorted((f for f, _ in space), key=list(TR.MODEL_GRIDS).index)
    drawn = TR.random_draws(space)
    assert len({json.dumps(d) for d in drawn}) == 50 and {f for f, _ in drawn} == set(TR.MODEL_GRIDS)
    for some in (space, drawn):
        fits = TR.shared_fits(some)
        assert sorted(i for _, _, members in fits for i in members) == list(range(len(some)))
        for family, params, members in fits:
            for i in members:
                full = {**TR.K.MODEL_DEFAULTS[family], **some[i][1]}
                differ = [k for k in full if full[k] != params[k]]
                assert some[i][0] == family and differ in ([], ["n_estimators"], ["fit_prior"], ["max_iter"])
    assert len(TR.shared_fits(space)) == 27


def test_registered_searches_fit_their_candidates(spark, monkeypatch):
    from textlathe.operators import training as TR
    from textlathe.plans.catalog import QUERIES, _fold_docs
    monkeypatch.setattr(TR.K, "MODEL_GRIDS", SMALL)
    rows = QUERIES["grid_search"](spark, SF001).collect()
    space = TR.search_space()
    assert [(r.family, json.loads(r.params)) for r in rows] == space and len(rows) == 9
    # the same scores from one fit a candidate and fold
    docs = _fold_docs(spark, SF001, 3)
    folds = TR.fold_vectors(docs, num_folds=3)
    for r, (family, params) in zip(rows, space):
        if family in ("random_forest", "svm"):
            continue
        want = []
        for train, held in folds:
            model = TR.estimator(family, train.count(), **params).fit(train)
            want.append(TR.positive_f1(TR.predictions(family, params, model, held)))
        assert abs(r.avg_f1 - sum(want) / 3) < 1e-9, (family, params)


def test_fold_features_come_from_training_rows_alone(spark):
    from pyspark.sql import functions as F
    from textlathe.operators import features as FX
    from textlathe.operators import training as TR
    texts = ["red apple tart", "green apple pie", "red wine glass", "green tea cup", "apple tea mix", "zebra zebra zebra"]
    docs = spark.createDataFrame([(i, t, i % 2, i % 3) for i, t in enumerate(texts)],
                                 "doc_id int, cleaned_text string, sentiment int, fold int")
    for fold, (train, held) in enumerate(TR.fold_vectors(docs, num_folds=3)):
        mine = docs.where(F.col("fold") != fold)
        model = FX.fit(mine)
        want = sorted(r.features.toArray().tolist() for r in FX.feature_vectors(model, mine, "doc_id").collect())
        assert sorted(r.features.toArray().tolist() for r in train.collect()) == want
        want = sorted(r.features.toArray().tolist() for r in
                      FX.feature_vectors(model, docs.where(F.col("fold") == fold), "doc_id").collect())
        assert sorted(r.features.toArray().tolist() for r in held.collect()) == want


def test_first_trees_of_a_boosted_model_are_the_shorter_fit(spark):
    import random
    from pyspark.ml.linalg import Vectors
    from textlathe.operators import training as TR
    rng = random.Random(1)
    rows = [(float(rng.random() < 0.5), Vectors.dense([rng.random() for _ in range(4)])) for _ in range(80)]
    data = spark.createDataFrame(rows, ["label", "features"]).coalesce(1)
    long = TR.estimator("gradient_boosting", 80, n_estimators=6, max_depth=3).fit(data)
    short = TR.estimator("gradient_boosting", 80, n_estimators=2, max_depth=3).fit(data)
    cut = TR.first_trees("gradient_boosting", long, 2)
    assert len(cut.treeWeights) == 2 and len(long.treeWeights) == 6
    assert [r.prediction for r in cut.transform(data).collect()] == [r.prediction for r in short.transform(data).collect()]
    forest = TR.estimator("random_forest", 80, n_estimators=5, max_depth=3).fit(data)
    few = TR.first_trees("random_forest", forest, 3)
    assert len(few.treeWeights) == 3 and few.transform(data).count() == 80


def test_cross_validation_fits_every_family(spark):
    from pyspark.ml.linalg import Vectors
    from textlathe.operators import training as TR
    rows = [(i % 3, float(i % 2), Vectors.dense([float(i % 2), 1.0 - i % 2])) for i in range(30)]
    data = spark.createDataFrame(rows, ["fold", "label", "features"])
    for family in TR.MODEL_GRIDS:
        params = {"n_estimators": 2} if "n_estimators" in TR.grid(family)[0] else {}
        assert TR.cross_validate(family, [params], data, num_folds=3) == [[1.0] * 3], family


def test_naive_bayes_without_prior_is_the_relational_one(spark):
    import random
    from pyspark.ml.linalg import Vectors
    from textlathe.operators import training as TR
    rng = random.Random(3)
    rows = [(i, float(i % 10 == 0), [float(rng.random() < 0.4) for _ in range(6)]) for i in range(200)]
    data = spark.createDataFrame([(i, y, Vectors.dense(x)) for i, y, x in rows], ["doc_id", "label", "features"])
    long = spark.createDataFrame([(i, k, v) for i, _, x in rows for k, v in enumerate(x) if v], "doc_id int, sel_idx int, value double")
    model = TR.estimator("naive_bayes", len(rows)).fit(data)
    found = {}
    for prior in (True, False):
        got = TR.predictions("naive_bayes", {"fit_prior": prior}, model, data)
        found[prior] = {r.doc_id: r.prediction for r in got.collect()}
        classes, lik = TR.naive_bayes_fit(long, data.select("doc_id", "label"), fit_prior=prior, n_features=6)
        want = TR.naive_bayes_predict(long, data.select("doc_id"), classes, lik)
        assert found[prior] == {r.doc_id: r.prediction for r in want.collect()}
    assert found[True] != found[False]


def test_naive_bayes_with_many_classes_is_the_plain_argmax(spark):
    import math
    import random
    import pytest
    from textlathe.operators import training as TR
    rng = random.Random(7)
    # sizes repeat (equal priors), one class has no feature, some documents share no term with any class
    train = {i: f"c{i % 150:03d}" if i % 3 else "hot" for i in range(900)}
    x = {i: {rng.randrange(40): rng.choice((0.25, 0.5, 1.0)) for _ in range(rng.randrange(4))}
         for i in range(900) if train[i] != "c001"}
    x.update({1000 + i: {rng.randrange(45): 1.0 for _ in range(i % 4)} for i in range(120)})
    x[2000] = {}
    rows = [(i, k, v) for i, t in x.items() for k, v in t.items()]
    feats = spark.createDataFrame(rows, "doc_id long, sel_idx int, value double")
    lab = spark.createDataFrame(list(train.items()), "doc_id long, label string")
    test = [i for i in x if i >= 1000]
    docs = spark.createDataFrame([(i,) for i in test], "doc_id long")
    for prior in (True, False):
        classes, lik = TR.naive_bayes_fit(feats, lab, fit_prior=prior, n_features=45)
        got = {r.doc_id: r.prediction for r in TR.naive_bayes_predict(
            feats.where("doc_id >= 1000"), docs, classes, lik).collect()}
        fc, n = {}, {}
        for i, c in train.items():
            n[c] = n.get(c, 0) + 1
            for k, v in x.get(i, {}).items():
                fc[c, k] = fc.get((c, k), 0.0) + v
        total = {c: sum(v for (d, _), v in fc.items() if d == c) + 45 for c in n}

        def score(c, t):
            p = math.log(n[c] / len(train)) if prior else -math.log(len(n))
            return p + sum(v * math.log((fc.get((c, k), 0.0) + 1.0) / total[c]) for k, v in t.items())
        assert set(got) == set(test)
        for i in test:
            best = max(score(c, x[i]) for c in n)
            near = sorted(c for c in n if score(c, x[i]) > best - 1e-9)
            assert got[i] in near and (x[i] or got[i] == near[0]), (i, got[i], near)
    with pytest.raises(ValueError, match="alpha"):
        TR.naive_bayes_fit(feats, lab, alpha=0.0)
    with pytest.raises(ValueError, match="null labels"):
        TR.naive_bayes_fit(feats, lab.unionByName(spark.createDataFrame([(5, None)], lab.schema)))
