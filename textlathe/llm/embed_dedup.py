"""Embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its hash is the nearest of the 2d signed axes. ``hashes`` of them
make a key, ``tables`` keys make a vector's buckets. With multiprobe a vector
also enters the buckets reached by replacing one axis by its second or third
choice, cheapest first. Vectors sharing a bucket are compared exactly, in
blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import cut, written
from textlathe.llm.components import connected_components
from textlathe.llm.vectors import unit, usable

ROUNDS = 3
SEED = 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate((y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]), axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


@lru_cache(maxsize=16)
def signs(dim: int, tables: int, hashes: int) -> np.ndarray:
    rng = np.random.default_rng((SEED, dim, tables, hashes))
    return rng.choice(np.array([-1.0, 1.0]), size=(tables, hashes, ROUNDS, dim))


def bucket_keys(x: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """Keys of unit rows, n x tables x (1 + probes), the base key first."""
    dim = 1 << max(1, (x.shape[1] - 1).bit_length())
    if dim > x.shape[1]:
        x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    flip = signs(dim, tables, hashes)
    choices = min(3, dim)
    out = np.empty((len(x), tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        axes = np.empty((len(x), hashes, choices), dtype=np.int64)
        size = np.empty((len(x), hashes, choices))
        for k in range(hashes):
            r = x
            for s in flip[t, k]:
                r = hadamard(r * s)
            a = np.abs(r)
            top = np.argpartition(-a, choices - 1, axis=1)[:, :choices]
            v = np.take_along_axis(a, top, 1)
            order = np.argsort(-v, axis=1, kind="stable")
            top = np.take_along_axis(top, order, 1)
            size[:, k] = np.take_along_axis(v, order, 1)
            axes[:, k] = 2 * top + (np.take_along_axis(r, top, 1) < 0)
        weight = (2 * dim) ** np.arange(hashes, dtype=np.int64)
        base = (axes[:, :, 0] * weight).sum(1)
        out[:, t, 0] = base
        move = ((axes[:, :, 1:] - axes[:, :, :1]) * weight[None, :, None]).reshape(len(x), -1)
        cost = ((size[:, :, :1] - size[:, :, 1:]) ** 2).reshape(len(x), -1)
        cheap = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t, 1:1 + cheap.shape[1]] = base[:, None] + np.take_along_axis(move, cheap, 1)
        out[:, t, 1 + cheap.shape[1]:] = base[:, None]
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _hash_rows(tables: int, hashes: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column(1).value_lengths())
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                keys = bucket_keys(unit(_vectors(part.column(1))), tables, hashes, probes)
                n, width = len(keys), tables * (1 + probes)
                table = np.broadcast_to(np.arange(tables)[None, :, None], keys.shape)
                # a vector enters a bucket once, even if two probes are the same
                flat = np.stack((np.repeat(np.arange(n), width), table.ravel(), keys.ravel()))
                flat = np.unique(flat, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(dims == d)).take(pa.array(flat[0])),
                     pa.array(flat[1].astype(np.int32)), pa.array(flat[2])], names=["cid", "t", "key"])
    return run


def compare_cell(x: np.ndarray, side: np.ndarray, across: bool, sizes: np.ndarray, cosine: float, t: int, key: int,
                 tables: int, hashes: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the vectors ``x`` of one cell of bucket (t, key);
    ``across``: only between different sides. Returns per vector the partners' sizes summed over
    links *counted here* (a pair that shares several buckets is counted in the
    first by table and key), and the smallest index it is connected to."""
    u = unit(x)
    s = u @ u.T
    ok = s >= cosine
    close = np.argwhere(np.abs(s - cosine) < 1e-12)
    for a, b in close:  # decided on the original vectors
        ok[a, b] = x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= cosine
    ok = ok & ok.T
    np.fill_diagonal(ok, False)
    if across:
        ok &= side[:, None] != side[None, :]
    root = np.arange(len(x))
    while True:  # smallest index over links, to a fixed point
        low = np.minimum(root, np.where(ok, root[None, :], len(x)).min(axis=1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    a, b = np.nonzero(np.triu(ok))
    counted = np.zeros(len(x), dtype=np.int64)
    if len(a):
        some = np.unique(np.concatenate((a, b)))
        place = np.full(len(x), -1)
        place[some] = np.arange(len(some))
        keys = bucket_keys(u[some], tables, hashes, probes)
        for i in range(0, len(a), 1 << 16):
            p, q = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
            first = np.ones(len(p), dtype=bool)
            for table in range(t + 1):
                kp, kq = keys[place[p], table], keys[place[q], table]
                shared = kp[:, :, None] == kq[:, None, :]
                if table == t:
                    shared &= kp[:, :, None] < key
                first &= ~shared.any(axis=(1, 2))
            np.add.at(counted, p[first], sizes[q[first]])
            np.add.at(counted, q[first], sizes[p[first]])
    return counted, root


def _compare(cosine: float, tables: int, hashes: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def cell(rows: pa.Table) -> pa.RecordBatch | None:
            if rows.num_rows < 2:
                return None
            t, key = rows["t"][0].as_py(), rows["key"][0].as_py()
            x = _vectors(rows["vec"].combine_chunks())
            cid, sizes = rows["cid"].to_numpy(), rows["size"].to_numpy()
            across = rows["i"][0].as_py() != rows["j"][0].as_py()
            counted, root = compare_cell(x, rows["side"].to_numpy(), across, sizes, cosine, t, key, tables, hashes,
                                         probes)
            linked = (counted > 0) | (root != np.arange(len(x)))
            if not linked.any():
                return None
            return pa.RecordBatch.from_arrays([pa.array(cid[linked]), pa.array(counted[linked]),
                                               pa.array(cid[root[linked]])], names=["cid", "n", "to"])

        same = ["bucket", "i", "j", "t", "key"]
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(batch.column(batch.schema.get_field_index(c))) for c in same]
            change = np.zeros(batch.num_rows, dtype=bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            if held:
                last = held[-1]
                change[0] = any(last.column(last.schema.get_field_index(c))[-1].as_py() != batch.column(
                    batch.schema.get_field_index(c))[0].as_py() for c in same)
            starts = np.flatnonzero(change).tolist()
            at = 0
            for s in [*starts, None]:
                if s is None:
                    held.append(batch.slice(at))
                else:
                    if s > at:
                        held.append(batch.slice(at, s - at))
                    if held and (got := cell(pa.Table.from_batches(held))) is not None:
                        yield got
                    held, at = [], s
        if held and (got := cell(pa.Table.from_batches(held))) is not None:
            yield got
    return run


def near_duplicate_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", *,
                           cosine: float = 0.98, tables: int = 8, probes: int = 3, hashes: int | None = None,
                           block: int = 512) -> DataFrame:
    """One row per row of ``df``: key, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest key reachable, itself included) and
    ``kept`` (key = component_id). Vectors link if their labels are equal and
    not null and their cosine is at least ``cosine``.

    Vectors that are null, zero, or hold a null or a non-finite component, rows
    with a null label, and rows with a null key link with nothing. Vectors of
    different lengths never link. Equal vectors of a label are one row (a
    class with its size) after the first aggregation. ``hashes`` defaults to
    the smallest number giving 64 buckets per vector of the largest label; at
    that width, 8 tables with 3 probes find a pair at 0.98 with probability
    over 0.99999 (measured in 64 dimensions).

    A bucket with more than ``block`` vectors is cut into blocks, and every
    pair of blocks is a cell that one task multiplies; a cell returns counts
    and one connection per vector, not pairs. A pair sharing several buckets is
    counted only in the first. Empty input gives no rows.
    """
    v = F.col(vector).cast("array<double>")
    takes_part = F.coalesce(usable(vector) & F.col(label).isNotNull() & F.col(key).isNotNull(), F.lit(False))
    rows = df.select(F.col(key).alias("_key"), F.when(takes_part, v).alias("vec"),
                     F.col(label).cast("string").alias("label"))
    rows = written(rows.withColumn("cid", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec"))), "vectors")
    classes = written(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.min("_key").alias("low"), F.count(F.lit(1)).cast("long").alias("size"),
        F.first("vec").alias("vec"), F.first("label").alias("label")), "vector-classes")
    if hashes is None:
        shape = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")) \
            .agg(F.max("n"), F.max("d")).first()
        width = 2 * (1 << max(1, ((shape[1] or 2) - 1).bit_length()))
        hashes = 1
        while width ** hashes < 64 * (shape[0] or 1) and width ** (hashes + 1) < 1 << 62:
            hashes += 1
    hashed = classes.select("cid", "vec").mapInArrow(_hash_rows(tables, hashes, probes), "cid long, t int, key long")
    entries = hashed.join(classes.select("cid", "label", F.size("vec").alias("dim")), "cid") \
        .select("cid", "t", "key", F.xxhash64("label", "dim", "t", "key").alias("bucket"))
    entries = written(entries, "vector-buckets")
    full = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1") \
        .select("bucket", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = (entries.join(full, "bucket").withColumn("side", mine)
             .select("*", F.explode(others).alias("other"))
             .select("cid", "bucket", "t", "key", "side", F.least("side", "other").alias("i"),
                     F.greatest("side", "other").alias("j"))
             .join(classes.select("cid", "size", "vec"), "cid"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(n, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "t", "key")
    found = written(dealt.mapInArrow(_compare(cosine, tables, hashes, probes), "cid long, n long, to long"),
                    "vector-links")
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    parts = cut(connected_components(found.where("cid <> to").select(F.col("cid").alias("a"), F.col("to").alias("b"))))
    rooted = classes.drop("vec", "label").join(parts.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("cid", "low", "size", F.coalesce("root", "cid").alias("root")).join(counts, "cid", "left")
    heads = rooted.groupBy("root").agg(F.min("low").alias("head"))
    labels = rooted.join(heads, "root").select(
        "cid", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), "head")
    out = rows.drop("vec", "label").join(labels, "cid", "left")
    component = F.coalesce("head", "_key")
    return out.select(F.col("_key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("_key") == component, F.lit(False)).alias("kept"))
