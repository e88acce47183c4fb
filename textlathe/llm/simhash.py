"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints have 64 bits. The bits are grouped into partitions, correlated
bits together, and every partition gets a threshold: with thresholds ``T_i``
(-1: partition unused) and ``sum(T_i + 1) = d + 1``, two fingerprints within
``d`` bits agree up to ``T_i`` bits in some partition ``i``. A dynamic program
chooses the thresholds with the smallest estimated work (probes plus
candidates), from bit counts over all fingerprints. Candidates are verified by
popcount.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import cut, row_digest, written
from textlathe.llm.components import connected_components

BITS = 64
_CHUNK = 1 << 16  # shingles counted at a time


def simhash64(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of one text: A-Z lower-cased, ``words``-word
    shingles with repeats (fewer words: the whole sequence), XXH64 of each; a
    bit is 1 if it is set in over half of the hashes. No words: 0."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space
    if not tokens:
        return 0
    line = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(line)]))
    k = min(words, len(tokens))
    n = len(tokens) - k + 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, _CHUNK):
        s, e = starts[i:min(i + _CHUNK, n)].tolist(), ends[i + k - 1:min(i + _CHUNK, n) + k - 1].tolist()
        h = np.array([digest(line[x:y], seed) for x, y in zip(s, e)], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: str, words: int = 3, seed: int = 42) -> Column:
    """Fingerprint column (long, the same bits)."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash64(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return prints(F.col(text).cast("string"))


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 matrix of how often two bits are
    set together, summed over all of them (4096 numbers reach the driver)."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            for i in range(0, len(b), 1 << 15):
                h = b["fp"].to_numpy(dtype=np.int64)[i:i + (1 << 15)]
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                total += bits.T @ bits
                n += len(h)
        if n:
            yield pd.DataFrame({"k": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = prints.select("fp").mapInPandas(partial, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    got = {r["k"]: r["n"] for r in rows}
    matrix = np.array([got.get(k, 0) for k in range(BITS * BITS)], dtype=np.float64).reshape(BITS, BITS)
    return int(got.get(BITS * BITS, 0)), matrix


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of nearly equal width with correlated bits together: each is
    seeded by the free bit with the most correlation left, and grown by the
    bit with the largest mean absolute correlation to it."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            best = max(free, key=lambda b: (corr[b, group].mean(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def within(q: np.ndarray, most: int) -> np.ndarray:
    """P(at most e of the independent events happen) for e = 0..most."""
    dist = np.zeros(most + 1)
    dist[0] = 1.0
    for x in q:
        dist[1:] = dist[1:] * (1 - x) + dist[:-1] * x
        dist[0] *= 1 - x
    return np.cumsum(dist)


def allocate(n: int, together: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """(estimated work, thresholds): dynamic program over the partitions with
    the budget ``sum(T_i + 1) = distance + 1``."""
    p = np.diag(together) / max(n, 1)
    costs = []
    for g in groups:
        near = within(2 * p[g] * (1 - p[g]), distance)
        probes, cost = 0, [0.0]
        for e in range(distance + 1):
            probes += sum(1 for _ in combinations(range(len(g)), e))
            cost.append(n * probes + n * (n - 1) / 2 * near[e])
        costs.append(cost)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, t) in best.items():
            for extra in range(distance + 2 - spent):
                total = c + cost[extra]
                if spent + extra not in step or total < step[spent + extra][0]:
                    step[spent + extra] = (total, [*t, extra - 1])
        best = step
    return best[distance + 1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def flips(bits: list[int], most: int) -> list[int]:
    """XOR masks (signed longs) that flip at most ``most`` of the bits."""
    return [_signed(sum(1 << b for b in c)) for e in range(most + 1) for c in combinations(bits, e)]


def links(prints: DataFrame, distance: int = 2, hot: int = 32) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``), every
    one at most ``distance`` bits apart, that connect exactly what all such
    pairs connect.

    Buckets (partition, value) of at most ``hot`` fingerprints are probed and
    verified pair by pair. The members of larger buckets, of any size, are
    linked without pairs: two fingerprints are within ``d`` bits exactly if a
    point lies within ``d - d // 2`` bits of the one and ``d // 2`` of the
    other, so each member is sent to all points around it (65 for two bits)
    and each point links its members to its smallest near member.
    """
    n, together = bit_counts(prints)
    if n < 2:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    plans = []
    for parts in range(2, distance + 3):
        groups = group_bits(n, together, parts)
        work, thresholds = allocate(n, together, groups, distance)
        plans.append((work, parts, groups, thresholds))
    _, _, groups, thresholds = min(plans, key=lambda x: x[:2])
    index, probe = [], []
    for i, (g, t) in enumerate(zip(groups, thresholds)):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in g))).cast("long"))
        index.append(F.struct(F.lit(i).alias("part"), value.alias("val")))
        probe += [F.struct(F.lit(i).alias("part"), value.bitwiseXOR(F.lit(m).cast("long")).alias("val")) for m in flips(g, t)]
    indexed = prints.select(F.col("fp").alias("b"), F.inline(F.array(*index)))
    probes = prints.select(F.col("fp").alias("a"), F.inline(F.array(*probe)))
    sizes = indexed.groupBy("part", "val").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    sizes = written(sizes, "simhash-buckets")
    cool, large = sizes.where(F.col("_n") <= hot).drop("_n"), sizes.where(F.col("_n") > hot).drop("_n")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    several = sizes if any(t > 0 for t in thresholds) else None
    if several is None:  # equal values only: a bucket of one has no pair
        pairs = probes.join(cool, ["part", "val"], "left_semi").join(indexed, ["part", "val"])
    else:
        pairs = probes.join(indexed.join(large, ["part", "val"], "left_anti"), ["part", "val"])
    pairs = pairs.where((F.col("a") < F.col("b")) & (differ <= distance)).select("a", "b")
    crowd = probes.join(large, ["part", "val"], "left_semi").select(F.col("a").alias("fp")).distinct()
    near, far = distance // 2, distance - distance // 2
    masks = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(bin(m & ((1 << 64) - 1)).count("1") <= near).alias("near"))
                      for m in flips(list(range(BITS)), far)])
    points = crowd.select("fp", F.inline(masks)).select("fp", "near", F.col("fp").bitwiseXOR(F.col("mask")).alias("point"))
    centres = points.groupBy("point").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("b"),
                                          F.count(F.lit(1)).alias("_n")).where("b IS NOT NULL AND _n > 1").drop("_n")
    stars = points.join(centres, "point").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    return pairs.union(stars)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = 3, distance: int = 2,
                    hot: int = 32) -> DataFrame:
    """One row per row of ``df``: ``key``, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest key reachable over links of at most ``distance``
    differing bits, itself included) and ``row_id``, ``representative``.

    Texts without words (null, empty, white space) have fingerprint zero and
    link like any other. Null keys take part; they are smallest only where a
    component has no other key (``component_id`` null). Rows equal in key and
    text share ``row_id``, the md5 of both; ``representative`` marks the
    ``row_id`` that stands for the component. Work is done on distinct
    fingerprints, so copies of one text are one row after the first, map-side
    combined, aggregation. Empty input gives no rows.
    """
    prints = written(df.select(F.col(key).alias("_key"), fingerprint(text, words).alias("fp"),
                               row_digest(key, text).alias("row_id")), "simhash-prints")
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), F.col("_key").alias("key"), F.col("row_id")))
    distinct = written(prints.groupBy("fp").agg(first.alias("first")), "simhash-distinct")
    parts = cut(connected_components(links(distinct.select("fp"), distance, hot)))
    rooted = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    labels = rooted.drop("first").join(heads, "root").select("fp", "head")
    return prints.join(labels, "fp").select(
        F.col("_key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("head.key").alias("component_id"), "row_id",
        (F.col("row_id") == F.col("head.row_id")).alias("representative"))


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", *, words: int = 3,
                distance: int = 2) -> DataFrame:
    """The rows of ``df`` with exactly one left of each component: the one with
    the smallest key (ties: the smallest md5 of key and text)."""
    groups = near_duplicates(df, key, text, words=words, distance=distance)
    heads = groups.where("representative").select(F.col("row_id").alias("_simhash_row")).distinct()
    return (df.withColumn("_simhash_row", row_digest(key, text)).join(heads, "_simhash_row", "left_semi")
            .dropDuplicates(["_simhash_row"]).drop("_simhash_row"))
