"""Mixing sources to target weights with a time-varying curriculum.

Every source has a weight schedule over training time 0..1, piecewise linear
between knots. Its integral is the source's share of the whole mix; shares
become token targets, capped at ``max_epochs`` times the source's size with
the excess reshared by weight. A source's documents stand in a reproducible
random order and are read again and again until the target is met. A document
whose words lie around token number ``c`` of its source is trained at the time
when the source's cumulative demand reaches ``c``: the inverse of the
integrated schedule. Sorting by that time gives the training order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlathe.llm.common import WORD_PATTERN, copies_apart, row_digest

# Default schedules, as (time, factor) knots of each rank in the weight cycle:
# the heavy class fades, the light class grows. Each integrates to 1.
CURRICULUM = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def integral(knots: Sequence[tuple[float, float]]) -> float:
    """Area under a piecewise linear schedule."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:]))


def inverse_demand(u: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which the share ``u`` (0..1) of a schedule's area is reached."""
    whole = integral(knots)
    if whole <= 0 or any(w < 0 for _, w in knots) or any(b[0] <= a[0] for a, b in zip(knots, knots[1:])):
        raise ValueError("knots need rising times, weights of at least 0 and a positive area")
    area, out = 0.0, None
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        step = (t1 - t0) * (w0 + w1) / 2
        rest = u * F.lit(whole) - F.lit(area)  # area still to cover in this piece
        slope = (w1 - w0) / (t1 - t0)
        if step == 0:
            time = F.lit(t1)
        elif slope == 0:
            time = F.lit(t0) + rest / F.lit(w0)
        else:  # w0 x + slope x^2 / 2 = rest, in the form without cancellation
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            time = F.lit(t0) + F.lit(2.0) * rest / F.greatest(F.lit(w0) + root, F.lit(1e-300))
        time = F.least(F.greatest(time, F.lit(t0)), F.lit(t1))
        area += step
        out = F.when(rest <= step, time) if out is None else out.when(rest <= step, time)
    return out.otherwise(F.lit(knots[-1][0]))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """Targets from one row per source (``source``, ``source_size``).

    Sources by code point, null last, take the weights in turn. All sizes
    together are shared out by weight; a target stops at ``max_epochs`` times
    its source's size and the excess is reshared by weight until none is above.
    The end of that process is a water level: with sources ordered by
    cap/weight, the level is the largest of (words left by the capped ones) /
    (weight of the others) over all prefixes, found with running sums. The
    table has one row per source, not per document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.select("source", "source_size", (F.pmod(rank, F.lit(len(weights)))).cast("int").alias("_class"),
                     weight.alias("_w"))
    s = s.withColumn("_cap", (F.col("source_size") * max_epochs).cast("double"))
    order = [F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()]
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("_level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
                     / F.sum("_w").over(rest))
    return s.select("source", "source_size", "_class",
                    F.least(F.col("_cap"), F.max("_level").over(whole) * F.col("_w")).alias("target"))


def curriculum(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *,
               weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3,
               schedules: Sequence[Sequence[tuple[float, float]]] = CURRICULUM,
               carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``df``: the key, the columns named in ``carry``,
    ``size`` (words of the text, null 0), ``source_size``, ``target`` and
    ``positions``, the rising training times (0..1) at which the document is
    read; empty if the mix does not take it, at most ``max_epochs`` entries.

    Documents are whole: the last reading of a source ends at the document
    boundary nearest to its target. The order inside a source is the md5 of
    (key, text), so reruns agree on any partitioning. A source is cut into 4096
    buckets by that digest, so one source holding most rows is summed over many
    tasks; the bucket totals give the offsets. Rows equal in key, text and
    source are interchangeable: without ``carry`` they are counted before the
    shuffle and expanded after it, in blocks of 10,000 that are dealt over the
    tasks; with ``carry`` they share a bucket.
    A null source is a source of its own (last). Documents without words are
    never taken (``positions`` empty). Empty input gives no rows. ``carry`` may
    not name an output column.
    """
    words = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    named = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))  # null-free, order kept
    carry = [c for c in carry if c != key]
    d = df.select(F.col(key).alias("_key"), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in carry]).alias("_carry"),
                  named.alias("_source"), words.alias("size"), row_digest(key, text).alias("_order"))
    if carry:
        d = d.withColumn("_copies", F.lit(1).cast("long"))
    else:
        d = d.groupBy("_key", "_source", "size", "_order", "_carry").agg(F.count(F.lit(1)).alias("_copies"))
    d = d.withColumn("_bucket", F.substring("_order", 1, 3))
    buckets = d.groupBy("_source", "_bucket").agg(F.sum(F.col("size") * F.col("_copies")).alias("_n"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = buckets.groupBy("_source").agg(F.sum("_n").alias("source_size")).select(
        F.when(F.col("_source") != "", F.substring("_source", 2, 2147483647)).alias("source"), "source_size")
    targets = source_targets(sizes, weights, max_epochs).withColumn(
        "_source", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    offsets = buckets.select("_source", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy("_source", "_bucket").orderBy("_order", "_key").rowsBetween(
        Window.unboundedPreceding, -1)
    d = d.withColumn("_before", F.coalesce(F.sum(F.col("size") * F.col("_copies")).over(local), F.lit(0)))
    d = d.join(offsets, ["_source", "_bucket"]).join(targets, "_source")
    d = d.withColumn("_copy", F.lit(0).cast("long")) if carry else copies_apart(d, "_order")
    # middle of the document in its source's stream of words
    middle = F.col("_offset") + F.col("_before") + F.col("_copy") * F.col("size") + F.col("size") / 2
    readings = F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: e * F.col("source_size") + middle)
    taken = F.when(F.col("size") > 0, F.filter(readings, lambda c: c <= F.col("target"))) \
        .otherwise(F.array().cast("array<double>"))

    def time(c: Column) -> Column:
        out = None
        for k, knots in enumerate(schedules):
            mine = F.pmod(F.col("_class"), F.lit(len(schedules))) == k
            x = inverse_demand(c / F.col("target"), knots)
            out = F.when(mine, x) if out is None else out.when(mine, x)
        return out

    return d.select(F.col("_key").alias(key), *[F.col(f"_carry.`{c}`") for c in carry], "size", "source_size",
                    "target", F.transform(taken, time).alias("positions"))


def training_order(placed: DataFrame) -> DataFrame:
    """Every reading of every document (``position``, ``epoch`` from 0), range
    partitioned and sorted by position: the mix as it is trained."""
    keep = [F.col(f"`{c}`") for c in placed.columns if c not in ("positions", "epoch", "position")]
    return (placed.select(*keep, F.posexplode("positions").alias("epoch", "position"))
            .repartitionByRange(F.col("position")).sortWithinPartitions("position"))
