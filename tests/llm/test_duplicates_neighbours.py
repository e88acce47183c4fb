"""SimHash and embedding near-duplicates, components, nearest neighbours:
each against brute force."""

import random

import numpy as np
import pytest
import xxhash

from textlathe.llm import components, embed_dedup, simhash, vptree


def roots(n, edges):
    at = list(range(n))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        at[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components_of_chains_hubs_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 199), (200, 199)]
    got = {r["node"]: r["root"] for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots(201, edges)
    assert got == {n: want[n] for e in edges for n in e}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def simhash_by_hand(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(spark):
    some = [None, "", " \t", "A", "a b", "One two three", "one two THREE four " * 9, "\u00c9 \u00e9\u2003x y z", "a\x0bb\x0cc d"]
    assert [simhash.simhash64(t) for t in some] == [simhash_by_hand(t) for t in some]
    assert simhash.simhash64("w " * 70000) == simhash_by_hand("w " * 70000)


@pytest.mark.parametrize("distance,hot", [(2, 32), (2, 1), (3, 1), (1, 2)])
def test_links_connect_what_all_pairs_connect(spark, distance, hot):
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for p in list(prints)[:20]:
        for _ in range(8):
            for b in rng.sample(range(64), rng.choice([1, 1, 2, 3])):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {(r["a"], r["b"]) for r in simhash.links(df, distance, hot).collect()}
    apart = lambda a, b: bin((a ^ b) & (2 ** 64 - 1)).count("1")
    assert all(0 < apart(a, b) <= distance for a, b in found)
    place = {p: i for i, p in enumerate(prints)}
    want = [(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints[:i]) if apart(a, b) <= distance]
    assert roots(len(prints), [(place[a], place[b]) for a, b in found]) == roots(len(prints), want)


def test_threshold_allocation_meets_the_budget():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, size=(500, 64)).astype(float)
    bits[:, 10] = bits[:, 3]
    together = bits.T @ bits
    for parts in (2, 3, 4):
        groups = simhash.group_bits(500, together, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        _, t = simhash.allocate(500, together, groups, 2)
        assert sum(x + 1 for x in t) == 3
    assert any({3, 10} <= set(g) for g in simhash.group_bits(500, together, 3))


def test_near_duplicates_edge_rows_and_dedup(spark):
    text = "alpha beta gamma delta " * 20
    rows = [(5, text, 1), (3, text, 2), (3, text, 2), (None, text, 3), (8, None, 4), (9, " ", 5), (None, "other", 6),
            (None, "other", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_id int")
    got = simhash.near_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [
        (0, 0), (0, 0), (0, 3), (3, 3), (3, 3), (5, 3), (8, 8), (9, 8)]
    assert {r["fingerprint"] for r in got if r["doc_id"] in (8, 9)} == {"0" * 16}
    left = simhash.deduplicate(df)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["row_id"]) for r in left.collect()) == [(0, 6), (3, 2), (8, 4)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def clouds(n, dim, near, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(near):
        x[n - 1 - i] = x[i % 5] + rng.normal(size=dim) * 0.1 * np.linalg.norm(x[i % 5]) / np.sqrt(dim)
    return np.round(x, 6)


@pytest.mark.parametrize("dim,block", [(64, 512), (20, 16)])
def test_embedding_links_equal_brute_force(spark, dim, block):
    x = clouds(260, dim, 120, dim)
    x[7] = x[6]
    labels = [i % 2 for i in range(259)] + [None]
    rows = [(1000 - i, v.tolist(), lab) for i, (v, lab) in enumerate(zip(x, labels))]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicate_vectors(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), block=block).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    lab = np.array([-1 if v is None else v for v in labels])
    ok = (u @ u.T >= 0.98) & (lab[:, None] == lab) & (lab >= 0)[:, None]
    np.fill_diagonal(ok, False)
    comp = roots(260, [(259 - i, 259 - j) for i, j in np.argwhere(ok)])
    assert got == {1000 - i: (int(ok[i].sum()), 741 + comp[259 - i]) for i in range(260)}


def test_embedding_edge_rows(spark):
    nan, v = float("nan"), [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0),
            (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 1.0], 0), (9, [1.0, nan, 1.0], 0), (None, v, 0), (10, [], 0),
            (11, [1.0, 2.0], 0), (12, [float("inf"), 1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS cid", "2 AS n_links")
    got = embed_dedup.near_duplicate_vectors(df).collect()
    links = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in got)
    assert links == sorted([(0, 0, None, False), (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False),
                            *[(k, 0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12)]])
    assert embed_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_vantage_point_search_is_exact_at_factor_one(spark):
    x = clouds(1500, 16, 200, 3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000 + i, rows[0][1]) for i in range(9)]          # copies of one vector
    rows += [(6000 + i, (2 * x[1]).tolist()) for i in range(9)]  # ties in cosine
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    trees = vptree.index(df, shard_rows=400)
    got = {}
    for r in vptree.nearest(trees, df.where("vec_id % 50 = 0"), block=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    ids, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    u = y / np.linalg.norm(y, axis=1)[:, None]
    for q in np.flatnonzero(ids % 50 == 0):
        s = np.round(u @ u[q], 12)
        s[q] = -9
        best = np.lexsort((ids, -s))[:5]
        assert [v for v, _ in got[ids[q]]] == ids[best].tolist()
        assert [c for _, c in got[ids[q]]] == pytest.approx(s[best].tolist(), abs=1e-9)


def test_relaxed_factor_keeps_recall():
    x = clouds(4000, 64, 600, 5)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    root, order = vptree.build(u, leaf=64)
    q = u[::50]
    exact = [set(np.argsort(-(u @ v))[:5]) for v in q]
    for factor, least in ((1.0, 1.0), (1.2, 0.95)):
        place, _ = vptree.search(root, u[order], q, 5, factor)
        hits = sum(len(set(order[p]) & e) for p, e in zip(place, exact))
        assert hits >= least * 5 * len(q)


def test_neighbours_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (50, [0.0, 1.0]), (100, [float("nan"), 1.0]),
            (None, [1.0, 0.0]), (0, [1.0, 0.0]), (4, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS id")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9))
                 for r in vptree.nearest(vptree.index(df), df.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0)]
    none = df.limit(0)
    assert vptree.nearest(vptree.index(df), none).count() == 0
    assert vptree.nearest(vptree.index(none), df).count() == 0
