"""Merkle manifest of a dataset, with membership proofs by pointer jumping.

Every row is a leaf; the leaves of a group, in key order, form a tree whose
nodes have ``arity`` children (the last run of a level fewer, even one), and the
groups' roots, in group order, form one more tree. A proof is the digests of
the siblings met on the way from a leaf to the root.

Every node starts with a segment: its siblings, and a pointer to its parent. In
a round, level ``l`` is joined with level ``l + d`` of the same nodes, so a
segment of ``d`` levels is lengthened by the one that begins where it ends and
the pointer reaches ``2 d`` levels up; only levels that are multiples of ``2 d``
go on. After ``log2(height)`` rounds every leaf holds its whole proof. A group's
root carries the group's own proof in the upper tree, so the last jump of a leaf
lands at the dataset's root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlathe.llm.common import written
from textlathe.operators.joins import bounded_broadcast, global_index, segmented_rank

SMALL_LEVEL = 40_000  # nodes of a level that is broadcast (under 2 KB each); larger levels are shuffled


def field_text(c: str) -> Column:
    """A value as ``bytes:value``, null as ``-``: no two different rows run
    together into one text."""
    v = F.col(c).cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_digest(columns: list[str], **instead: Column) -> Column:
    """SHA-256 (binary) of the named columns; ``instead`` replaces the text of
    single columns."""
    return F.unhex(F.sha2(F.concat(*[instead.get(c, field_text(c)) for c in columns]), 256))


def nothing() -> Column:
    return F.lit(bytearray())


def hex_text(c: str | Column) -> Column:
    return F.lower(F.hex(c))


def _level(runs: DataFrame, arity: int) -> DataFrame:
    """The nodes of a level that have siblings to name, from its runs: one row a
    node with its first segment. A group's only node is its root (``done``)."""
    kid = F.posexplode("kids").alias("idx", "kid")
    size = F.size("kids")
    sibling = [F.when(F.col("idx") != i, F.coalesce(F.get("kids", F.lit(i))["h"], nothing())).otherwise(nothing())
               for i in range(arity)]
    alone = (F.col("up") == 0) & (F.col("size") == 1)
    return (runs.select("g", "up", size.alias("size"), "kids", kid)
            .select("g", F.col("kid.pos").alias("pos"), F.col("kid.pay").alias("pay"), alone.alias("done"),
                    F.when(alone, nothing()).otherwise(F.concat(*sibling)).alias("seg"),
                    F.when(alone, F.lit("")).otherwise(F.concat(F.col("size").cast("string"),
                                                                F.col("idx").cast("string"))).alias("path"),
                    F.when(alone, F.col("kid.h")).alias("subroot")))


def _build(leaves: DataFrame, arity: int) -> list[tuple[DataFrame, int]]:
    """Runs of every level from the leaves ``(g, pos, h, pay)`` upwards: rows
    ``(g, up, kids)`` and their number. A run has at most ``arity`` rows, so the
    grouping has no hot key; every level is a third of the one below."""
    empty = F.lit(None).cast(leaves.schema["pay"].dataType)
    nodes, levels = leaves, []
    while True:
        runs = (nodes.groupBy("g", F.floor(F.col("pos") / arity).cast("long").alias("up"))
                .agg(F.sort_array(F.collect_list(F.struct("pos", "h", "pay"))).alias("kids")))
        runs = written(runs, f"merkle-level-{len(levels)}")
        levels.append((runs, runs.count()))
        above = runs.where((F.col("up") > 0) | (F.size("kids") > 1))
        if above.isEmpty():
            return levels
        joined = F.concat(*[F.coalesce(F.get("kids", F.lit(i))["h"], nothing()) for i in range(arity)])
        nodes = above.select("g", F.col("up").alias("pos"), F.unhex(F.sha2(hex_text(joined), 256)).alias("h"),
                             empty.alias("pay"))


def _jump(low: DataFrame, high: DataFrame, span: int, nodes: int) -> DataFrame:
    """Segments of ``low`` lengthened by those of their ancestors in ``high``,
    ``span`` positions a node. Finished nodes meet nobody, and their join key is
    spread. A key of ``high`` has at most ``span`` descendants; where that is
    many, ``high`` is small and broadcast."""
    target = F.when(F.col("done"), -1 - F.col("pos")).otherwise(F.floor(F.col("pos") / span).cast("long"))
    h = high.select(F.col("g").alias("_g"), F.col("pos").alias("_pos"), F.col("seg").alias("_seg"),
                    F.col("path").alias("_path"), F.col("subroot").alias("_subroot"), F.col("done").alias("_done"))
    both = low.withColumn("_to", target).join(bounded_broadcast(h, nodes, SMALL_LEVEL),
                                             (F.col("g") == F.col("_g")) & (F.col("_to") == F.col("_pos")), "left")
    return both.select("g", "pos", "pay", (F.col("done") | F.coalesce("_done", F.lit(False))).alias("done"),
                       F.concat("seg", F.coalesce("_seg", nothing())).alias("seg"),
                       F.concat("path", F.coalesce("_path", F.lit(""))).alias("path"),
                       F.coalesce("subroot", "_subroot").alias("subroot"))


def _proofs(levels: list[tuple[DataFrame, int]], arity: int, upper: DataFrame | None, groups: int = 1) -> DataFrame:
    """One row per leaf: ``g, pos, pay, seg, path, subroot``. ``upper`` holds
    ``(g, seg, path)`` that the group's root begins with."""
    tables = [_level(runs, arity) for runs, _ in levels]
    if upper is not None:
        u = bounded_broadcast(upper.select(F.col("g").alias("_g"), F.col("seg").alias("_seg"),
                                           F.col("path").alias("_path")), groups, SMALL_LEVEL)
        # only a group's root has a partner; the key of other nodes is spread
        at = F.when(F.col("done"), F.col("g")).otherwise(F.concat(F.lit("-"), F.col("pos").cast("string")))
        tables = [t.withColumn("_at", at).join(u, F.col("_at") == F.col("_g"), "left")
                  .select("g", "pos", "pay", "done", F.coalesce("_seg", "seg").alias("seg"),
                          F.coalesce("_path", "path").alias("path"), "subroot") for t in tables]
    d = 1
    while d < len(tables):
        for low in range(0, len(tables) - d, 2 * d):
            tables[low] = _jump(tables[low], tables[low + d], arity ** d, levels[low + d - 1][1])
        d *= 2
    return tables[0]


def manifest(df: DataFrame, leaf: Column, *, group: str, key: str, carry: dict[str, Column] | None = None,
             arity: int = 3) -> DataFrame:
    """One row per row of ``df``: the columns of ``carry``, then ``leaf`` and
    ``subroot`` (binary), ``siblings`` (binary: the proof, level by level to the
    root, left to right), ``path`` (two digits a level: nodes of the run, place
    in it) and ``root`` (binary).

    Leaves of a group stand in ascending ``key`` order (nulls first, equal keys
    by digest, so repeated rows have places of their own); groups in bytewise
    order, null first. A lone leaf is its group's root, a lone group's root the
    dataset's. An empty table gives an empty manifest. Long texts are hashed
    where they are read and never shuffled. Other columns of ``df`` are not
    carried and may have any name.
    """
    if not 2 <= arity <= 9:
        raise ValueError("arity from 2 to 9")
    carried = {f"c{i}": c for i, c in enumerate((carry or {}).values())}
    g = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit("n"))
    rows = df.select(g.alias("g"), F.col(key).alias("k"), leaf.alias("h"),
                     F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in carried.items()]).alias("pay"))
    rows = written(rows, "merkle-leaves")
    ranked = segmented_rank(rows, ["g"], [F.col("k").asc_nulls_first(), F.col("h"), F.col("pay")], "pos")
    # the leaf's digest is carried beside its proof
    leaves = ranked.select("g", (F.col("pos") - 1).alias("pos"), "h", F.struct("pay.*", "h").alias("pay"))
    levels = _build(leaves, arity)
    tops = [runs.where((F.col("up") == 0) & (F.size("kids") == 1)).select("g", F.col("kids")[0]["h"].alias("h"))
            for runs, _ in levels]
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.union(t)
    subroots = written(subroots, "merkle-subroots")
    groups = subroots.count()
    roots = global_index(subroots, [F.col("g")], "pos").select(F.lit("").alias("g"), "pos", "h",
                                                               F.struct(F.col("g").alias("of")).alias("pay"))
    top_levels = _build(roots, arity)
    root = top_levels[-1][0].select(F.col("kids")[0]["h"]).first()
    upper = _proofs(top_levels, arity, None).select(F.col("pay.of").alias("g"), "seg", "path")
    if len(top_levels) > 1 or groups > 1:
        upper = written(upper, "merkle-upper")
    out = _proofs(levels, arity, upper, groups)
    return out.select(*[F.col(f"pay.{n}").alias(name) for n, name in zip(carried, carry or {})],
                      F.col("pay.h").alias("leaf"), "subroot", F.col("seg").alias("siblings"), "path",
                      F.lit(None if root is None else bytearray(root[0])).cast("binary").alias("root"))


def fold(leaf: str, siblings: str, path: str) -> Column:
    """Root (lowercase hex) that a leaf (lowercase hex) and its proof lead to.
    The three are stored columns, or come from a generator: they are read once a
    level."""
    start = F.struct(F.col(leaf).alias("h"), F.lit(0).alias("at"))

    def up(state: Column, level: Column) -> Column:
        size = F.substring(F.col(path), 2 * level + 1, F.lit(1)).cast("int")
        left = F.substring(F.col(path), 2 * level + 2, F.lit(1)).cast("int")
        before = F.substring(F.col(siblings), state["at"] + 1, 32 * left)
        after = F.substring(F.col(siblings), state["at"] + 32 * left + 1, 32 * (size - 1 - left))
        return F.struct(F.sha2(F.concat(hex_text(before), state["h"], hex_text(after)), 256).alias("h"),
                        (state["at"] + 32 * (size - 1)).alias("at"))

    levels = F.floor(F.length(path) / 2).cast("int")
    steps = F.when(levels > 0, F.sequence(F.lit(0), levels - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, up, lambda s: s["h"])
