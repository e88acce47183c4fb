import math

import pytest
from pyspark.sql import functions as F

from textlathe.operators import split as SP


def _draw(counts, share):
    """Plain stratified draw: (train, test) of each class, in label order."""
    n = sum(counts)
    n_test = math.ceil(share * n)
    shares = [c / n * (n - n_test) for c in counts]
    take = [math.floor(x) for x in shares]
    order = sorted(range(len(counts)), key=lambda i: (-(shares[i] - take[i]), i))
    for i in order[:n - n_test - sum(take)]:
        take[i] += 1
    return take, [c - t for c, t in zip(counts, take)]


def _train_first(counts, p=SP.SplitParams()):
    labels = sorted(counts)
    train, rest = _draw([counts[k] for k in labels], p.test_size + p.val_size)
    return dict(zip(labels, zip(train, *_draw(rest, p.val_size / (p.test_size + p.val_size)))))


def _sizes(split_df, label="sentiment"):
    out = {}
    for r in split_df.groupBy(label).pivot("split", ["train", "test", "val"]).count().na.fill(0).collect():
        out[r[label]] = (r["train"], r["test"], r["val"])
    return out


def _labelled(spark, counts):
    labels = [k for k, n in counts.items() for _ in range(n)]
    kind = "string" if isinstance(labels[0], str) else "int"
    return spark.createDataFrame(list(enumerate(labels)), f"doc_id long, sentiment {kind}")


@pytest.mark.parametrize("n,temp", [(10, 4), (20, 7), (100, 31), (1000, 301)])
def test_first_draw_sizes_follow_float_arithmetic(spark, n, temp):
    q = _sizes(SP.stratified_split(_labelled(spark, {0: n // 2, 1: n - n // 2})))
    assert sum(a for a, _, _ in q.values()) == n - temp
    assert sum(b + c for _, b, c in q.values()) == temp


def test_largest_remainder_ties_go_to_smaller_labels(spark):
    def take(counts, draws):
        d = spark.createDataFrame(list(enumerate(counts)), "k int, _n long")
        floors = sum(math.floor(c / sum(counts) * draws) for c in counts)
        got = SP.largest_remainder(d, "k", sum(counts), draws, floors)
        return [r["_take"] for r in got.orderBy("k").collect()]
    assert take([5, 3, 2], 7) == [4, 2, 1]
    assert take([7, 7, 7], 10) == [4, 3, 3]
    assert take([4, 4], 4) == [2, 2]


@pytest.mark.parametrize("counts,words", [({0: 1, 1: 50}, "only 1 member"), ({i: 2 for i in range(30)}, "test_size")])
def test_classes_too_small_to_split_raise(spark, counts, words):
    with pytest.raises(ValueError, match=words):
        SP.stratified_split(_labelled(spark, counts))


def test_null_labels_and_empty_tables_raise(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, sentiment int")
    for call in (SP.stratified_split, SP.stratified_folds):
        with pytest.raises(ValueError, match="null labels"):
            call(df)
    with pytest.raises(ValueError, match="empty"):
        SP.stratified_split(df.where("false"))


def test_many_classes_need_no_list_of_them(spark, monkeypatch):
    # a hot class and many equal ones (ties)
    counts = {f"c{i:04d}": 7 + i % 3 for i in range(500)} | {"hot": 2000}
    df = _labelled(spark, counts)
    want = _train_first(counts)
    assert _sizes(SP.stratified_split(df)) == want
    test, val = SP.SplitParams().test_size, SP.SplitParams().val_size
    labels = sorted(counts)
    rest, te = _draw([counts[k] for k in labels], test)
    tr, va = _draw(rest, val / (1 - test))
    d = df.withColumn("text", F.lit("x"))
    assert _sizes(SP.split_test_first(d)) == dict(zip(labels, zip(tr, te, va)))
    folds = SP.stratified_folds(df, 5)
    plain = {k: [0] * 5 for k in labels}
    at = 0
    for k in labels:
        for i in range(at, at + counts[k]):
            plain[k][i % 5] += 1
        at += counts[k]
    got = {k: [0] * 5 for k in labels}
    for r in folds.groupBy("sentiment", "fold").count().collect():
        got[r.sentiment][r.fold] = r["count"]
    assert got == plain
    # the same without any broadcast
    from textlathe.operators import joins
    monkeypatch.setattr(SP, "bounded_broadcast", lambda d, n: joins.bounded_broadcast(d, n, 10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _sizes(SP.stratified_split(df)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _frame(spark, n=300):
    rows = [(i, i % 3 if i % 10 else 0) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, sentiment int")


def test_split_exact_disjoint_and_stable(spark):
    df = _frame(spark)
    counts = {r[0]: r[1] for r in df.groupBy("sentiment").count().collect()}
    q = _train_first(counts)
    a = SP.stratified_split(df)
    got = {(r.sentiment, r.split): r["count"] for r in a.groupBy("sentiment", "split").count().collect()}
    for k, (tr, te, va) in q.items():
        assert got.get((k, "train"), 0) == tr and got.get((k, "test"), 0) == te and got.get((k, "val"), 0) == va
    assert a.select("doc_id").distinct().count() == 300
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        b = SP.stratified_split(df.repartition(7))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_split_matches_plain_rank(spark):
    df = _frame(spark)
    counts = {r[0]: r[1] for r in df.groupBy("sentiment").count().collect()}
    q = _train_first(counts)
    rows = sorted(df.collect(), key=lambda r: (r.sentiment,))
    import hashlib
    exp = {}
    for k in counts:
        ids = sorted((hashlib.md5(f"69:{r.doc_id}".encode()).hexdigest(), r.doc_id) for r in rows if r.sentiment == k)
        tr, te, _ = q[k]
        for pos, (_, i) in enumerate(ids, 1):
            exp[i] = "train" if pos <= tr else "test" if pos <= tr + te else "val"
    got = {r.doc_id: r.split for r in SP.stratified_split(df).collect()}
    assert got == exp


def test_folds_balanced(spark):
    df = _frame(spark)
    f = SP.stratified_folds(df, 5)
    per = {(r.sentiment, r.fold): r["count"] for r in f.groupBy("sentiment", "fold").count().collect()}
    for k in (0, 1, 2):
        sizes = [per.get((k, i), 0) for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert f.count() == 300


def test_unstratified_when_no_label(spark):
    df = spark.range(20).withColumnRenamed("id", "doc_id")
    s = SP.split_data(df)
    got = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    # 20 rows: 7 go to test+val (ceil(0.30000000000000004 * 20)), then ceil(1/3 * 7) = 3 to val
    assert got == {"train": 13, "test": 4, "val": 3}


def test_split_keeps_nothing_in_memory(spark):
    df = spark.range(200).selectExpr("id AS doc_id", "id % 3 AS sentiment")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    SP.stratified_split(df).count()
    SP.stratified_folds(df, 4).count()
    assert not df.is_cached
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
