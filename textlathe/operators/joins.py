"""Join and ordering helpers shared by the operators.

Broadcast is only ever requested for a side whose row count is *proven*
bounded: either by construction (a ``limit(k)`` with a checked ``k``), or by a
count taken on a small aggregate. Beyond the bound the plain join is kept and
AQE decides from runtime sizes (it may still pick a broadcast, or split skewed
partitions).
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# Upper bound on rows for an explicit broadcast hint. A vocabulary or label
# table of this many short rows stays well under the default 8 GB broadcast
# limit and the executors' memory.
BROADCAST_MAX_ROWS = 2_000_000


def bounded_broadcast(df: DataFrame, bound: int | None,
                      max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``bound`` (a proven upper bound on its rows) is
    within ``max_rows``; otherwise ``df`` unchanged (shuffle join / AQE)."""
    if bound is not None and bound <= max_rows:
        return F.broadcast(df)
    return df


def range_tag(df: DataFrame, keys: list[str], order_cols: list, num_partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned on ``keys + order_cols``, with the number of
    the range in ``_pid``, checkpointed.

    The bounds come from sampling; every branch that reads the result must see
    one assignment, also after an executor is lost, so it is kept in the shared
    checkpoint folder instead of being computed again.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(p, *[F.col(k) for k in keys], *order_cols)
    return ranged.withColumn("_pid", F.spark_partition_id()).checkpoint()


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; keeps the left keys."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                           *[F.col(c) for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def global_index(df: DataFrame, order_cols: list, name: str = "idx",
                 base: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Dense 0/1-based position of each row in a total order, without moving
    all rows to one task.

    Rows are range-partitioned on the order, each range partition numbers its
    rows locally, and a small table of per-partition counts gives the offsets.
    ``order_cols`` must define a total order (add a unique tie-breaker).
    """
    ranged = range_tag(df, [], order_cols, num_partitions)
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols)))
    # one row per range partition, not per data row: the driver adds them up
    counts = sorted(tuple(r) for r in ranged.groupBy("_pid").agg(F.count(F.lit(1))).collect())
    ends = accumulate(n for _, n in counts)
    offsets = df.sparkSession.createDataFrame(
        [(pid, end - n) for (pid, n), end in zip(counts, ends)], "_pid int, _off long")
    out = local.join(bounded_broadcast(offsets, len(counts)), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_lrn") - 1 + base).cast("long")) \
              .drop("_pid", "_lrn", "_off")


def segmented_rank(df: DataFrame, keys: list[str], order_cols: list, name: str = "rank",
                   num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` within ``keys`` ordered by ``order_cols`` (1-based),
    safe when one key holds a large share of all rows.

    A plain ``Window.partitionBy(keys)`` sends each key to one task. Here rows
    are range-partitioned on ``keys + order``, so a hot key spreads over many
    partitions; each (partition, key) slice is numbered locally, and a small
    table of slice counts (at most partitions + keys rows) supplies the
    offsets. Null keys are a key like any other. ``order_cols`` must make the
    order total inside a key.
    """
    ranged = range_tag(df, keys, order_cols, num_partitions)
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order_cols)))
    slices = ranged.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_pid", *keys, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    out = join_null_safe(local, offsets, ["_pid", *keys])
    return out.withColumn(name, (F.col("_off") + F.col("_lrn")).cast("long")) \
              .drop("_pid", "_lrn", "_off")


def segmented_running(df: DataFrame, keys: list[str], order_cols: list,
                      sums: dict | None = None, lasts: dict | None = None,
                      inclusive: bool = True, num_partitions: int | None = None,
                      tagged: bool = False) -> DataFrame:
    """Running sums and running "last non-null" values inside ``keys``
    ordered by ``order_cols`` (a total order), safe under key skew.

    ``sums``: {out: numeric Column}; ``lasts``: {out: Column} (last non-null
    value so far; wrap a value in a struct to let nulls count). With
    ``inclusive=False`` the current row is left out.

    Each (range partition, key) slice is scanned with a local window; a small
    table of per-slice totals and last values (at most partitions + keys rows)
    gives each slice its carry-in, joined back null-safely on (partition, key).
    ``tagged``: ``df`` comes from :func:`range_tag` with an order that refines
    this one, so several scans share one range partitioning; ``_pid`` is kept.
    """
    sums, lasts = sums or {}, lasts or {}
    base = df if tagged else range_tag(df, keys, order_cols, num_partitions)
    ranged = base.select("*", *[c.alias(f"_v_{n}") for n, c in sums.items()],
                         *[c.alias(f"_l_{n}") for n, c in lasts.items()])
    wl = Window.partitionBy("_pid", *keys).orderBy(*order_cols)
    frame = wl.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = ranged.select("*", *[F.sum(f"_v_{n}").over(frame).alias(f"_s_{n}") for n in sums],
                          *[F.last(f"_l_{n}", ignorenulls=True).over(frame).alias(f"_t_{n}") for n in lasts])
    o = F.struct(*order_cols)
    slices = ranged.groupBy("_pid", *keys).agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.sum(f"_v_{n}").alias(f"_S_{n}") for n in sums],
        *[F.max_by(f"_l_{n}", F.when(F.col(f"_l_{n}").isNotNull(), o)).alias(f"_L_{n}") for n in lasts])
    wk = (Window.partitionBy(*keys) if keys else Window).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = slices.select("_pid", *keys,
                          *[F.coalesce(F.sum(f"_S_{n}").over(wk), F.lit(0)).alias(f"_c_{n}") for n in sums],
                          *[F.last(f"_L_{n}", ignorenulls=True).over(wk).alias(f"_k_{n}") for n in lasts])
    out = join_null_safe(local, carry, ["_pid", *keys])
    out = out.select("*", *[(F.col(f"_c_{n}") + F.coalesce(f"_s_{n}", F.lit(0))).alias(n) for n in sums],
                     *[F.coalesce(f"_t_{n}", f"_k_{n}").alias(n) for n in lasts])
    drop = ([] if tagged else ["_pid"]) + [x for n in sums for x in (f"_v_{n}", f"_s_{n}", f"_c_{n}")] \
        + [x for n in lasts for x in (f"_l_{n}", f"_t_{n}", f"_k_{n}")]
    return out.drop(*drop)
