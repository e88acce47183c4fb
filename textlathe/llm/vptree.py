"""Approximate nearest neighbours with vantage-point trees, one per shard.

Vectors are scaled to length one; the chord between two of them is a metric
that orders like the cosine. A tree node holds a vantage point and splits its
vectors at the median chord; for each half it keeps the smallest and largest
chord to the vantage point. A half is skipped if ``factor`` times the lower
bound on its chords, by the triangle inequality, exceeds the k-th chord found
so far. With factor 1 only halves that cannot hold a neighbour are skipped, so
the search is exact; a larger factor skips more.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textlathe.llm.common import written
from textlathe.llm.vectors import unit, usable

LEAF = 256
QUERY_BLOCK = 8192       # queries broadcast at a time: at most this many vectors
SHARD_ROWS = 16384       # vectors of a tree, on average
SALTS = 64


@dataclass
class Node:
    """Inner nodes have a vantage point and two halves with chord bounds;
    leaves have rows ``start`` to ``end``."""

    start: int
    end: int
    point: np.ndarray | None = None
    halves: tuple = ()  # (node, smallest chord, largest chord)


def chord(u: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (u @ point), 0.0))


def build(u: np.ndarray, leaf: int = LEAF, seed: int = 7) -> tuple[Node, np.ndarray]:
    """Tree over unit rows and the row order in which leaves are runs. Halves
    are split by rank, so ties and equal vectors split evenly."""
    rng = np.random.default_rng(seed)
    order = np.arange(len(u))

    def grow(start: int, end: int) -> Node:
        if end - start <= leaf:
            return Node(start, end)
        rows = order[start:end]
        point = u[rows[rng.integers(len(rows))]]
        d = chord(u[rows], point)
        half = (end - start) // 2
        by = np.argpartition(d, half)
        order[start:end], d = rows[by], d[by]
        middle = start + half
        node = Node(start, end, point)
        node.halves = ((grow(start, middle), d[:half].min(), d[:half].max()),
                       (grow(middle, end), d[half:].min(), d[half:].max()))
        return node

    root = grow(0, len(u))
    return root, order


def search(root: Node, u: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """For each query, the places (in tree order) and chords of its k nearest
    found; -1 and infinity where there are fewer. All queries walk the tree
    together: a half is visited first by the queries on its side, then by the
    others that still cannot skip it."""
    near = np.full((len(queries), k), np.inf)
    place = np.full((len(queries), k), -1, dtype=np.int64)

    def visit(node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.point is None:
            d = np.sqrt(np.maximum(2.0 - 2.0 * (queries[q] @ u[node.start:node.end].T), 0.0))
            d = np.concatenate((near[q], d), axis=1)
            at = np.concatenate((place[q], np.broadcast_to(np.arange(node.start, node.end), (len(q), node.end - node.start))),
                                axis=1)
            best = np.argpartition(d, k - 1, axis=1)[:, :k]
            near[q], place[q] = np.take_along_axis(d, best, 1), np.take_along_axis(at, best, 1)
            return
        d = chord(queries[q], node.point)
        bounds = [np.maximum(np.maximum(low - d, d - high), 0.0) for _, low, high in node.halves]
        inner = bounds[0] <= bounds[1]
        for first in (0, 1):
            visit(node.halves[first][0], q[inner if first == 0 else ~inner])
        for second in (1, 0):
            mine = inner if second == 1 else ~inner
            # chords are rounded: a bound within 1e-9 of the k-th chord is not skipped
            open_ = factor * bounds[second][mine] <= near[q[mine]].max(axis=1) + 1e-9
            visit(node.halves[second][0], q[mine][open_])

    visit(root, np.arange(len(queries)))
    return place, near


def within(root: Node, u: np.ndarray, queries: np.ndarray, radius: np.ndarray, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of every vector at most ``radius`` away, so that all that
    tie with a query's k-th neighbour are seen."""
    asked, found = [], []

    def visit(node: Node, q: np.ndarray) -> None:
        if not len(q):
            return
        if node.point is None:
            d = np.sqrt(np.maximum(2.0 - 2.0 * (queries[q] @ u[node.start:node.end].T), 0.0))
            a, b = np.nonzero(d <= radius[q, None] + 1e-9)
            asked.append(q[a])
            found.append(b + node.start)
            return
        d = chord(queries[q], node.point)
        for half, low, high in node.halves:
            bound = np.maximum(np.maximum(low - d, d - high), 0.0)
            visit(half, q[factor * bound <= radius[q] + 1e-9])

    visit(root, np.arange(len(queries)))
    asked, found = np.concatenate(asked), np.concatenate(found)
    order = np.argsort(asked, kind="stable")
    return asked[order], found[order]


def _build_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and dimension: one tree for each run of them."""
    held: list[pa.RecordBatch] = []
    at = None

    def close() -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        x = np.array(t["vec"].combine_chunks().flatten(), dtype=np.float64).reshape(t.num_rows, -1)
        root, order = build(unit(x))
        return pa.RecordBatch.from_pydict(
            {"dim": pa.array([x.shape[1]], pa.int32()), "n": pa.array([len(x)], pa.int64()),
             "tree": pa.array([pickle.dumps(root)], pa.binary()), "vecs": pa.array([x[order].tobytes()], pa.binary()),
             "ids": pa.array([[t["ids"][int(i)].as_py() for i in order]], pa.list_(pa.list_(pa.int64())))})

    for batch in batches:
        shards, dims = np.array(batch.column(0)), np.array(batch.column(1))
        edges = np.flatnonzero((shards[1:] != shards[:-1]) | (dims[1:] != dims[:-1])) + 1
        for s, e in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            if e == s:
                continue
            here = (shards[s], dims[s])
            if at is not None and here != at:
                yield close()
                held = []
            at = here
            held.append(batch.slice(s, e - s))
    if held:
        yield close()


def index(df: DataFrame, key: str = "vec_id", vector: str = "embedding", *, k: int = 5,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: one row per shard and dimension with its tree, vectors and,
    for each vector, its ``k + 1`` smallest keys.

    Vectors that are null, zero or hold a null or non-finite component, and
    null keys, take no part. Equal vectors are one row: their smallest keys are
    all that a search can return, since ties go to the smaller key; they are
    picked in two steps over ``SALTS`` salts, so copies of one vector never
    meet in one task. Shards are dealt by a hash of the vector and hold about
    ``shard_rows`` of them.
    """
    v = F.col(vector).cast("array<double>")
    rows = df.where(usable(vector) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), v.alias("vec"))
    rows = rows.withColumn("cid", F.xxhash64("vec")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    first = Window.partitionBy("cid", "salt").orderBy("id")
    few = rows.select("cid", "salt", "id").distinct().withColumn("r", F.row_number().over(first)).where(f"r <= {k + 1}")
    ids = few.groupBy("cid").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids"))
    vecs = rows.groupBy("cid").agg(F.first("vec").alias("vec"))
    classes = written(vecs.join(ids, "cid"), "vptree-classes")
    shards = max(1, -(-classes.count() // shard_rows))
    dealt = classes.select(F.pmod(F.col("cid"), F.lit(shards)).cast("int").alias("shard"),
                           F.size("vec").alias("dim"), "vec", "ids")
    dealt = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "dim")
    trees = dealt.mapInArrow(_build_shard, "dim int, n long, tree binary, vecs binary, ids array<array<long>>")
    return written(trees, "vptree-index")


def nearest(trees: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", *, k: int = 5,
            factor: float = 1.0, block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every query its ``k`` nearest
    indexed vectors (all, if fewer) but the one of its own key, by cosine in
    double precision; ties go to the smaller key.

    Queries are searched in blocks of at most ``block`` vectors, the proven
    bound of what is broadcast; each block meets every shard, a shard returns
    ``k`` candidates a query, and these are merged by rank before the shuffle.
    Queries that are null, zero or not finite, or have a null key, get no rows;
    repeated query keys count once (the smallest vector). Vectors of another
    length than the query are never neighbours.
    """
    v = F.col(vector).cast("array<double>")
    asked = queries.where(usable(vector) & F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")) \
        .agg(F.min(v).alias("vec"))
    spark = queries.sparkSession
    asked = written(asked, "vptree-queries")
    n = asked.count()
    blocks = max(1, -(-n // block))
    # equal blocks by rank of the hashed key, so that none is over the bound
    cuts = [] if blocks == 1 else asked.select(F.xxhash64("id").cast("double").alias("h")).approxQuantile(
        "h", [i / (2 * blocks) for i in range(1, 2 * blocks)], 0.1 / blocks)
    edges = [float("-inf"), *cuts, float("inf")]
    out = None
    for low, high in zip(edges, edges[1:]):
        h = F.xxhash64("id").cast("double")
        rows = asked.where((h >= low) & (h < high) if blocks > 1 else F.lit(True)).select("id", "vec")
        found = _search_block(spark, trees, rows.limit(2 * block + 1).toPandas(), k, factor, 2 * block)
        found = written(found, "vptree-found")
        out = found if out is None else out.union(found)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_block(spark, trees: DataFrame, rows, k: int, factor: float, bound: int) -> DataFrame:
    if len(rows) > bound:
        raise RuntimeError("a query block is over its bound")
    vecs = [np.asarray(x, dtype=np.float64) for x in rows["vec"]]
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {len(x) for x in vecs}:
        mine = [i for i, x in enumerate(vecs) if len(x) == d]
        by_dim[d] = (rows["id"].to_numpy(dtype=np.int64)[mine], np.stack([vecs[i] for i in mine]))
    sent = spark.sparkContext.broadcast(by_dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch.column(0)[r].as_py()
                if dim not in sent.value:
                    continue
                ids, q = sent.value[dim]
                root = pickle.loads(batch.column(2)[r].as_py())
                x = np.frombuffer(batch.column(3)[r].as_py(), dtype=np.float64).reshape(-1, dim)
                keys = batch.column(4)[r].as_py()
                u, v = unit(x), unit(q)
                _, near = search(root, u, v, k + 1, factor)  # one more: the query itself
                asked, found = within(root, u, v, near.max(axis=1), factor)
                ends = np.searchsorted(asked, np.arange(len(q) + 1))
                query, vec, score = [], [], []
                for i in range(len(q)):
                    hits = found[ends[i]:ends[i + 1]]
                    s = cosine(x[hits], q[i])
                    got = sorted((-c, key) for c, p in zip(s.tolist(), hits.tolist())
                                 for key in keys[p] if key != ids[i])[:k]
                    query += [int(ids[i])] * len(got)
                    vec += [key for _, key in got]
                    score += [-c for c, _ in got]
                yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(vec, pa.int64()),
                                                  pa.array(score, pa.float64())], names=["query_id", "vec_id", "score"])

    return trees.mapInArrow(run, "query_id long, vec_id long, score double")


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q`` on the original vectors."""
    return np.einsum("ij,j->i", x, q) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("i,i->", q, q)))
