"""Jump-hash shards, URL vocabulary and curriculum mixing."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textlathe.llm import mixing, queries_a, shards, url_filter


def jump_by_hand(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2 ** 64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=50), st.integers(1, 40))
def test_jump_hash_is_the_published_loop(keys, n):
    got = shards.jump_hash(np.array(keys, dtype=np.uint64), n)
    assert got.tolist() == [jump_by_hand(k, n) for k in keys]


def test_appending_a_shard_moves_only_into_it():
    keys = np.arange(20000, dtype=np.uint64) * np.uint64(2654435761)
    a, b = shards.jump_hash(keys, 16), shards.jump_hash(keys, 17)
    assert set(b[a != b]) == {16}
    assert abs((a != b).mean() - 1 / 17) < 0.01


DOCS = [(1, "one two", "a"), (2, None, "a"), (3, "", None), (4, "one two", "b"), (4, "one two", "b"),
        (None, "x y z", None), (None, None, "a"), (7, "é\u2003w " * 50, "c")]


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_shard_slots_defined_for_nulls_repeats_and_clashes(spark):
    df = docs(spark).selectExpr("*", "'x' AS shard", "1 AS slot", "2 AS size")
    rows = shards.shard_slots(df, n_shards=3).collect()
    assert len(rows) == len(DOCS)
    for s in range(3):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 3)
    want = sorted((-1 if k is None else k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in DOCS)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert len({r["shard"] for r in rows if r["doc_id"] == 4}) == 1
    assert shards.shard_slots(docs(spark, [])).count() == 0


@pytest.mark.parametrize("url,host,path", [
    (None, "", ""), ("", "", ""), ("no scheme/x", "", ""), ("http://A.Org", "a.org", ""),
    ("http://a.org?x=/en/", "a.org", ""), ("x://a.org/p#q?r", "a.org", "/p"), ("http://a.org#/p", "a.org", ""),
    ("http://É.Org:8/p?http://b.com/", "É.org:8", "/p")])
def test_split_url(url, host, path):
    assert url_filter.split_url(url) == (host, path)


def test_urls_rules_terms_and_boundaries(spark):
    rules = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"))
    urls = [None, "", "http://m.example.org/es/x", "http://example.org/en", "http://badexample.org/es/",
            "http://x.com/de/", "http://x.com", "http://xxx.net/", "http://axxx.net/", "http://y.net/free-WIN",
            "http://y.net/free/free", "http://y.net/freewin", "http://porn.org/", "http://porn.org"]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id int, url string, verdict string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["n_strict"], r["n_soft"])
           for r in url_filter.judge_urls(df, rules=rules).collect()}
    assert got == {0: (None, "allow", 0, 0), 1: (None, "allow", 0, 0), 2: ("example.org/es/", "block", 0, 0),
                   3: ("org/", "allow", 0, 0), 4: ("org/", "allow", 0, 0), 5: ("com/de/", "block", 0, 0),
                   6: (None, "allow", 0, 0), 7: (None, "block", 1, 0), 8: (None, "allow", 0, 0),
                   9: (None, "block", 0, 2), 10: (None, "allow", 0, 1), 11: (None, "allow", 0, 0),
                   12: ("org/", "allow", 1, 0), 13: (None, "block", 1, 0)}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def targets_by_hand(sizes, weights, cap):
    """Reshare the excess by weight until no source is above its cap."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        w = sum(weights[i % len(weights)] for i in free)
        share = {i: rest * weights[i % len(weights)] / w for i in free}
        over = [i for i in free if share[i] > cap * sizes[i] + 1e-9]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed.update({i: cap * sizes[i] for i in over})


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=8))
def test_source_targets_match_repeated_resharing(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "source string, source_size long")
    got = [r["target"] for r in mixing.source_targets(df).orderBy("source").collect()]
    assert got == pytest.approx(targets_by_hand(sizes, (5, 2, 1), 3), abs=1e-6)


def test_curriculum_takes_whole_documents_near_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 30))), ["a", "b", "c", None][int(rng.integers(0, 4)) % (1 + i % 4)])
            for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "9 AS target")
    got = mixing.curriculum(df).collect()
    again = {(r["doc_id"], tuple(r["positions"])) for r in mixing.curriculum(df.repartition(7)).collect()}
    assert again == {(r["doc_id"], tuple(r["positions"])) for r in got}
    for s in ("a", "b", "c", None):
        ids = {i for i, _, x in rows if x == s}
        mine = [r for r in got if r["doc_id"] in ids]
        taken = sum(r["size"] * len(r["positions"]) for r in mine)
        assert abs(taken - mine[0]["target"]) <= 15  # half of the longest document
        assert all(len(r["positions"]) <= 3 and list(r["positions"]) == sorted(r["positions"]) for r in mine)
        assert all(not r["positions"] for r in mine if r["size"] == 0)
        assert all(0 <= p <= 1 for r in mine for p in r["positions"])
    order = [r["position"] for r in mixing.training_order(mixing.curriculum(df)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r["positions"]) for r in got)


def test_curriculum_nulls_repeats_and_empty(spark):
    got = mixing.curriculum(docs(spark)).collect()
    assert len(got) == len(DOCS)
    carried = mixing.curriculum(docs(spark), carry=["text"]).collect()
    assert sorted(map(str, (r["text"] for r in carried))) == sorted(map(str, (t for _, t, _ in DOCS)))
    assert mixing.curriculum(docs(spark, [])).count() == 0


def test_inverse_demand_inverts_the_schedule(spark):
    from pyspark.sql import functions as F
    for knots in mixing.CURRICULUM:
        rows = spark.range(0, 101).select((F.col("id") / 100).alias("u")).select(
            "u", mixing.inverse_demand(F.col("u"), knots).alias("t")).collect()
        for r in rows:
            upto = [(t, w) for t, w in knots if t < r["t"]]
            w = float(np.interp(r["t"], *zip(*knots)))
            assert mixing.integral([*upto, (r["t"], w)]) if upto else r["u"] == pytest.approx(0, abs=1e-9)
            area = mixing.integral([*upto, (r["t"], w)]) if upto else 0.0
            assert area == pytest.approx(r["u"] * mixing.integral(knots), abs=1e-9)


def test_copies_of_one_row_come_out_of_many_tasks(spark):
    df = spark.range(45000).select(F.lit(7).alias("doc_id"), F.lit("the same").alias("text"), F.lit("s").alias("source"))
    slots = shards.shard_slots(df).select("slot", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["slot"] for r in slots) == list(range(45000)) and len({r["task"] for r in slots}) > 1
    placed = mixing.curriculum(df, max_epochs=1).select("positions", F.spark_partition_id().alias("task")).collect()
    first = sorted(r["positions"][0] for r in placed)
    assert len(set(first)) == 45000 and len({r["task"] for r in placed}) > 1
    shares = (np.arange(45000) + 0.5) / 45000
    assert np.allclose(first, 2 * shares / (1.5 + np.sqrt(2.25 - 2 * shares)))


def test_documents_not_taken_are_spread(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("s").alias("source"))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = queries_a.op6_curriculum_mix(spark, str(tmp_path)).select("*", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == 3000 and max(Counter(r["task"] for r in out).values()) < 2000
