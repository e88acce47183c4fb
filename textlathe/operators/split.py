"""Exact, reproducible stratified splits and folds.

Sizes follow the reference's splitter: ``n_test = ceil(test_share * n)``,
``n_train = n - n_test``; per-class counts by largest remainder (ties: label
ascending, where the reference draws at random); errors for classes with one
member or sides with fewer rows than classes. The split is two draws: train
vs. rest with share ``test + val``, then test vs. val of the rest with share
``val / (test + val)`` (float arithmetic as in Python).

Membership: inside a class, rows are ordered by ``md5("<seed>:<id>")`` then
id, so any partitioning and any engine give the same rows.

Scale: any number of classes. Class counts and quotas are tables; the driver
sees their totals only, and the largest remainders are ranked by a
range-partitioned index. The order key's first hex digits form buckets; a small
(class, bucket) count table gives, per class, the bucket holding each cut. Rows
in other buckets are assigned by comparison alone; only rows of the (at most two
per class) cut buckets are ranked with a window, whose partitions are a bucket
each, so a class holding most rows does not land on one task.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..session import ensure_checkpoint_dir
from .joins import bounded_broadcast, global_index, segmented_running

BUCKET_HEX = 4  # 65,536 buckets per class


@dataclass(frozen=True)
class SplitParams:
    train_size: float = K.TRAIN_SIZE
    test_size: float = K.TEST_SIZE
    val_size: float = K.VAL_SIZE
    random_state: int = K.RANDOM_STATE

    @classmethod
    def from_json(cls, s: str | dict | None) -> "SplitParams":
        d = s if isinstance(s, dict) else (json.loads(s) if s else {})
        base = cls()
        return cls(d.get("train_size", base.train_size), d.get("test_size", base.test_size),
                   d.get("val_size", base.val_size), d.get("random_state", base.random_state))


def _shuffle_sizes(n: int, test_share: float) -> tuple[int, int]:
    n_test = math.ceil(test_share * n)
    n_train = n - n_test
    if n_train <= 0 or n_test <= 0:
        raise ValueError(f"With n_samples={n}, test_size={test_share} the resulting train set would be empty.")
    return n_train, n_test


def largest_remainder(classes: DataFrame, label_col: str, total: int, n_draws: int, floors: int) -> DataFrame:
    """``classes`` (label, ``_n``) with ``_take``: draws proportional to ``_n``
    that sum to ``n_draws``. ``total`` and ``floors`` are the sums of ``_n`` and of
    :func:`_floor_share`; what the floors leave goes to the largest remainders
    (ties: smaller label)."""
    floor = _floor_share(total, n_draws)
    if n_draws <= floors:
        return classes.withColumn("_take", floor)
    left = classes.withColumn("_left", _share(total, n_draws) - floor)
    ranked = global_index(left, [F.col("_left").desc(), F.col(label_col).asc()], "_rank")
    return ranked.withColumn("_take", floor + F.when(F.col("_rank") < n_draws - floors, 1).otherwise(0)).drop("_left", "_rank")


def _share(total: int, n_draws: int):
    return F.col("_n").cast("double") / F.lit(float(total)) * F.lit(float(n_draws))


def _floor_share(total: int, n_draws: int):
    return F.floor(_share(total, n_draws))


def stratified_draw(classes: DataFrame, label_col: str, n: int, n_classes: int, test_share: float) -> DataFrame:
    """One stratified draw from ``n`` rows of ``n_classes`` classes: ``classes``
    (label, ``_n``) with ``_take``, the train rows of each."""
    n_train, n_test = _shuffle_sizes(n, test_share)
    floors, least = classes.agg(F.sum(_floor_share(n, n_train)), F.min("_n")).first()
    if least < 2:
        raise ValueError("The least populated class in y has only 1 member, which is too few. "
                         "The minimum number of groups for any class cannot be less than 2.")
    if n_train < n_classes:
        raise ValueError(f"The train_size = {n_train} should be greater or equal to the number of classes = {n_classes}")
    if n_test < n_classes:
        raise ValueError(f"The test_size = {n_test} should be greater or equal to the number of classes = {n_classes}")
    return largest_remainder(classes, label_col, n, n_train, floors)


def two_draws(classes: DataFrame, label_col: str, n: int, n_classes: int, first: float, second: float) -> DataFrame:
    """(label, ``_kept``, ``_first``, ``_second``): rows of each class that the
    first draw keeps, and how the second divides the others."""
    a = stratified_draw(classes, label_col, n, n_classes, first)
    rest = a.select(label_col, F.col("_take").alias("_kept"), (F.col("_n") - F.col("_take")).alias("_n"))
    b = stratified_draw(rest, label_col, _shuffle_sizes(n, first)[1], n_classes, second)
    return b.select(label_col, "_kept", F.col("_take").alias("_first"), (F.col("_n") - F.col("_take")).alias("_second"))


def order_key(id_col: str, seed: int):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_counts(buckets: DataFrame, label_col: str) -> tuple[DataFrame, int, int]:
    """(label, ``_n``) of every class, the number of rows and of classes."""
    classes = buckets.groupBy(label_col).agg(F.sum("_n").alias("_n"))
    n, k, nulls = classes.agg(F.sum("_n"), F.count(F.lit(1)), F.count_if(F.col(label_col).isNull())).first()
    if nulls:
        raise ValueError("null labels: drop them before splitting")
    return classes, n or 0, k


def bucket_counts(df: DataFrame, label_col: str, id_col: str, seed: int) -> DataFrame:
    """(class, bucket, count), combined map-side and checkpointed: class counts
    and cuts are both read from it, so ``df`` is read once for them."""
    ensure_checkpoint_dir(df.sparkSession)
    bucket = F.substring(order_key(id_col, seed), 1, BUCKET_HEX)
    return df.groupBy(label_col, bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).checkpoint()


def assign_by_quota(df: DataFrame, label_col: str, id_col: str, seed: int, quotas: DataFrame, n_classes: int,
                    buckets: DataFrame, names=("train", "test", "val"), out: str = "split") -> DataFrame:
    """Give each row ``names[j]`` by its rank inside its class in hash order:
    ranks up to ``_c1`` -> names[0], up to ``_c2`` -> names[1], rest -> names[2].
    ``quotas``: (label, ``_c1``, ``_c2``), one row for each of ``n_classes``
    classes; ``buckets``: :func:`bucket_counts` of ``df``."""
    keyed = (df.withColumn("_h", order_key(id_col, seed))
               .withColumn("_b", F.substring("_h", 1, BUCKET_HEX)))
    bc = buckets
    w = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bc = bc.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    bc = bc.join(bounded_broadcast(quotas, n_classes), label_col)  # one row per class
    # Per class: B1 = first bucket holding a rank > c1, B2 = first bucket
    # holding a rank > c2. Buckets before B1 are all names[0]; between B1 and
    # B2 all names[1]; after B2 all names[2]; B1 and B2 themselves are ranked.
    past1 = F.col("_start") + F.col("_n") > F.col("_c1")
    past2 = F.col("_start") + F.col("_n") > F.col("_c2")
    cuts = bc.groupBy(label_col).agg(
        F.min(F.when(past1, F.struct("_b", "_start"))).alias("_k1"),
        F.min(F.when(past2, F.struct("_b", "_start"))).alias("_k2"),
        F.first("_c1").alias("_c1"), F.first("_c2").alias("_c2"))
    cuts = cuts.select(label_col, "_c1", "_c2",
                       F.col("_k1._b").alias("_b1"), F.col("_k1._start").alias("_s1"),
                       F.col("_k2._b").alias("_b2"), F.col("_k2._start").alias("_s2"))
    # one row per class; many classes are joined by key
    j = keyed.join(bounded_broadcast(cuts, n_classes), label_col)
    b, b1, b2 = F.col("_b"), F.col("_b1"), F.col("_b2")
    in1 = b1.isNotNull() & (b == b1)
    in2 = b2.isNotNull() & (b == b2)
    whole = (F.when(in1 | in2, F.lit(None))
              .when(b1.isNull() | (b < b1), F.lit(names[0]))
              .when(b2.isNull() | (b < b2), F.lit(names[1]))
              .otherwise(F.lit(names[2])))
    j = j.withColumn(out, whole)
    done = j.where(F.col(out).isNotNull())
    mixed = j.where(F.col(out).isNull())
    start = F.when(in1, F.col("_s1")).otherwise(F.col("_s2"))
    r = start + F.row_number().over(Window.partitionBy(label_col, "_b").orderBy("_h", id_col))
    mixed = mixed.withColumn("_r", r).withColumn(
        out, F.when(F.col("_r") <= F.col("_c1"), F.lit(names[0]))
              .when(F.col("_r") <= F.col("_c2"), F.lit(names[1])).otherwise(F.lit(names[2]))).drop("_r")
    return done.unionByName(mixed).select(*[c for c in df.columns if c != out], out)


def stratified_split(df: DataFrame, label_col: str | None = "sentiment", id_col: str = "doc_id",
                     params: SplitParams = SplitParams(), stratify: bool = True) -> DataFrame:
    """``df`` + ``split`` in {train, test, val}.

    ``df`` is read twice, for its bucket counts and for the assignment; an
    expensive plan should be written before. Nothing is kept in memory."""
    seed = params.random_state
    first, second = params.test_size + params.val_size, params.val_size / (params.test_size + params.val_size)
    if stratify:
        buckets = bucket_counts(df, label_col, id_col, seed)
        classes, n, k = class_counts(buckets, label_col)
        quotas = two_draws(classes, label_col, n, k, first, second).select(
            label_col, F.col("_kept").alias("_c1"), (F.col("_kept") + F.col("_first")).alias("_c2"))
        return assign_by_quota(df, label_col, id_col, seed, quotas, k, buckets)
    # one class for all rows (an md5 has 32 digits); not a literal, so that the
    # cut table is joined by key like any other
    one = F.coalesce(F.length(order_key(id_col, seed)) - 32, F.lit(0))
    tmp = df.withColumn("_all", one)
    buckets = bucket_counts(tmp, "_all", id_col, seed)
    _, n, _ = class_counts(buckets, "_all")
    n_train, n_rest = _shuffle_sizes(n, first)
    n_test, _ = _shuffle_sizes(n_rest, second)
    quotas = df.sparkSession.createDataFrame([(0, n_train, n_train + n_test)], "_all int, _c1 long, _c2 long")
    return assign_by_quota(tmp, "_all", id_col, seed, quotas, 1, buckets).drop("_all")


def reproduce_split(df: DataFrame, split_params: str | dict, label_col: str = "sentiment",
                    id_col: str = "doc_id") -> DataFrame:
    """The same split from stored params (missing keys take defaults)."""
    return stratified_split(df, label_col, id_col, SplitParams.from_json(split_params))


def split_test_first(df: DataFrame, label_col: str = "sentiment", id_col: str = "doc_id",
                     test_size: float | None = None, validation_size: float | None = None,
                     random_state: int | None = None, text_col: str | None = None) -> DataFrame:
    """Test first, then validation from the rest; zero/None arguments fall
    back to the defaults; keeps only (id, text, label, split)."""
    test_size = test_size or K.TEST_SIZE
    validation_size = validation_size or K.VAL_SIZE
    random_state = random_state or K.RANDOM_STATE
    if text_col is None:
        text_col = "cleaned_text" if "cleaned_text" in df.columns else "text"
    d = df.select(id_col, F.col(text_col).alias("text"), label_col).na.drop(subset=["text", label_col])
    buckets = bucket_counts(d, label_col, id_col, random_state)
    classes, n, k = class_counts(buckets, label_col)
    # the rest of the test draw first; validation has the share validation / (1 - test) of it
    a = stratified_draw(classes, label_col, n, k, test_size)
    rest = a.select(label_col, F.col("_take").alias("_n"), (F.col("_n") - F.col("_take")).alias("_c1"))
    b = stratified_draw(rest, label_col, _shuffle_sizes(n, test_size)[0], k, validation_size / (1 - test_size))
    # rank order: test first, then validation, then train
    quotas = b.select(label_col, "_c1", (F.col("_c1") + F.col("_n") - F.col("_take")).alias("_c2"))
    return assign_by_quota(d, label_col, id_col, random_state, quotas, k, buckets, names=("test", "val", "train"))


def split_report(split_df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """E5: rows per (split, label)."""
    return split_df.groupBy("split", label_col).agg(F.count(F.lit(1)).alias("n"))


def stratified_folds(df: DataFrame, k: int = 5, label_col: str = "sentiment", id_col: str = "doc_id",
                     seed: int = K.RANDOM_STATE, out: str = "fold") -> DataFrame:
    """Fold ids 0..k-1. Classes are laid out in label order; the row at
    overall position ``offset(class) + rank`` gets ``position mod k``, which
    gives every fold the same per-class counts as stratified k-fold, with
    members chosen by the hash order. Ranks come from a window over (class,
    bucket) slices plus bucket offsets: one balanced shuffle."""
    buckets = bucket_counts(df, label_col, id_col, seed)
    classes, _, n_classes = class_counts(buckets, label_col)
    n_buckets, least = buckets.count(), classes.agg(F.min("_n")).first()[0]
    if least is not None and least < k:
        raise ValueError(f"n_splits={k} cannot be greater than the number of members in each class.")
    offsets = segmented_running(classes, [], [F.col(label_col).asc()], sums={"_off": F.col("_n")}, inclusive=False)
    keyed = (df.withColumn("_h", order_key(id_col, seed))
               .withColumn("_b", F.substring("_h", 1, BUCKET_HEX)))
    w = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bc = (buckets.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0)))
                 .join(bounded_broadcast(offsets.select(label_col, "_off"), n_classes), label_col)
                 .select(label_col, "_b", (F.col("_start") + F.col("_off")).alias("_base")))
    j = keyed.join(bounded_broadcast(bc, n_buckets), [label_col, "_b"])
    pos = F.col("_base") + F.row_number().over(Window.partitionBy(label_col, "_b").orderBy("_h", id_col)) - 1
    return j.withColumn(out, F.pmod(pos, F.lit(k)).cast("int")).drop("_h", "_b", "_base")


def split_data(df: DataFrame, label_col: str = "sentiment", id_col: str = "doc_id",
               params: SplitParams = SplitParams()) -> DataFrame:
    """Stratified on ``label_col`` when the column exists, otherwise
    the unstratified split."""
    if label_col in df.columns:
        return stratified_split(df, label_col, id_col, params)
    return stratified_split(df, None, id_col, params, stratify=False)
