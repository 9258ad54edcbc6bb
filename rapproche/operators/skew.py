"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapproche.session import stage

HOT_ROW_BYTES = 128


@dataclass(frozen=True)
class SkewLimits:
    """``task_rows``: rows of one key that may share a task; ``broadcast_bytes``: largest side to broadcast;
    ``task_pairs``: pairs of one key that a task may join."""

    task_rows: int = 500_000
    broadcast_bytes: int = 64 * 1024 * 1024
    task_pairs: int = 2_000_000


def hot_keys(df: DataFrame, key: str, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """All keys with more than ``task_rows`` rows: (_hot, _rows), counted exactly and written once.

    They are fewer than the rows over ``task_rows``. Should they still outgrow the broadcast bound, those with the
    fewest rows are left whole; the table steers only the split, and any such table gives right joins.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_rows"))
    found = stage(counted.where(F.col("_rows") > limits.task_rows), "hot-keys")
    least = limits.task_rows
    while not fits_broadcast(found, HOT_ROW_BYTES, limits):
        least *= 2
        found = found.where(F.col("_rows") > least)
    return found


def hot_pairs(left: DataFrame, right: DataFrame, left_key: str, right_key: str, limits: SkewLimits) -> tuple[DataFrame, DataFrame]:
    """The keys that an inner join splits, once per side: (_hot, _rows, _parts).

    A key is split where a side has more than ``task_rows`` rows of it, and where both sides together make more than
    ``task_pairs`` pairs, which takes far fewer rows. Keys are counted exactly. As in ``hot_keys``, the lightest ones are
    left whole should the table outgrow the broadcast bound.
    """
    counts = [
        df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias(name))
        for df, key, name in ((left, left_key, "_n1"), (right, right_key, "_n2"))
    ]
    both = counts[0].hint("merge").join(counts[1], "_hot", "full").fillna(0, ["_n1", "_n2"])
    blocks = F.col("_n1").cast("double") * F.col("_n2") / limits.task_pairs
    weight = F.greatest(F.col("_n1") / limits.task_rows, F.col("_n2") / limits.task_rows, blocks)
    found = stage(both.withColumn("_blocks", blocks).withColumn("_weight", weight).where("_weight > 1"), "hot-pairs")
    least = 1.0
    while not fits_broadcast(found, HOT_ROW_BYTES, limits):
        least *= 2
        found = found.where(F.col("_weight") > least)

    def side(name: str) -> DataFrame:
        wanted = F.greatest(F.ceil(F.col(name) / limits.task_rows), F.ceil(F.sqrt("_blocks")), F.lit(1))
        parts = F.greatest(F.least(wanted, F.col(name)), F.lit(1)).cast("int")
        return found.select("_hot", F.col(name).alias("_rows"), parts.alias("_parts")).where("_parts > 1")

    return side("_n1"), side("_n2")


def _with_parts(df: DataFrame, key: str, hot: DataFrame | None, task_rows: int, name: str) -> DataFrame:
    """``df`` with the number of parts its key is split in: 1 for all but the hot keys."""
    if hot is None:
        return df.withColumn(name, F.lit(1))
    split = F.col("_parts") if "_parts" in hot.columns else F.ceil(F.col("_rows") / task_rows).cast("int")
    parts = hot.select("_hot", split.alias("_parts"))
    joined = df.join(F.broadcast(parts), F.col(key) == F.col("_hot"), "left")
    return joined.withColumn(name, F.coalesce("_parts", F.lit(1))).drop("_hot", "_parts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    limits: SkewLimits = SkewLimits(),
    hot: tuple[DataFrame | None, DataFrame | None] | None = None,
) -> DataFrame:
    """Equi-join whose hot keys are cut in blocks: the rows of each side are dealt to parts and copied to each part of
    the other side, so every pair meets exactly once and no task holds more than ``task_rows`` rows a side of one key, nor
    makes more than about ``task_pairs`` pairs of it.

    ``how`` is inner, left, left_semi or left_anti; for the last three only the left side is cut. The parts are chosen
    by a hash of the row, so a recomputed task deals them the same way. Key columns must differ in name. Neither side
    is broadcast, however small its compressed bytes make it look: that would pass it through the driver.
    """
    keep_left = how in ("left", "left_outer", "left_semi", "leftsemi", "left_anti", "leftanti")
    if hot is None:
        hot = (hot_keys(left, left_key, limits), None) if keep_left else hot_pairs(left, right, left_key, right_key, limits)
    hot_left, hot_right = (None if h is None or h.isEmpty() else h for h in hot)
    on = F.col(left_key) == F.col(right_key)
    if hot_left is None and hot_right is None:
        return left.hint("merge").join(right, on, how)

    def dealt(
        df: DataFrame, key: str, own: DataFrame | None, other: DataFrame | None, own_salt: str, other_salt: str
    ) -> DataFrame:
        row = F.xxhash64(*df.columns)
        df = _with_parts(df.withColumn("_row", row), key, own, limits.task_rows, "_own")
        df = _with_parts(df, key, other, limits.task_rows, "_other")
        # Never null, so that the join infers no filter on it and pushes no copy of the row's expressions down.
        part = F.coalesce(F.pmod("_row", "_own").cast("int"), F.lit(0))
        copies = F.explode(F.sequence(F.lit(0), F.col("_other") - 1))
        return df.withColumn(own_salt, part).withColumn(other_salt, copies).drop("_row", "_own", "_other")

    a = dealt(left, left_key, hot_left, hot_right, "_l0", "_r0")
    b = dealt(right, right_key, hot_right, hot_left, "_r1", "_l1")
    salts = (F.col("_l0") == F.col("_l1")) & (F.col("_r0") == F.col("_r1"))
    return a.hint("merge").join(b, on & salts, how).drop("_l0", "_r0", "_l1", "_r1")


def fits_broadcast(df: DataFrame, row_bytes: int, limits: SkewLimits = SkewLimits()) -> bool:
    """Whether ``df`` is small enough to broadcast; counting stops at the bound."""
    most = max(1, limits.broadcast_bytes // row_bytes)
    return df.limit(most + 1).count() <= most


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    big_key: str,
    table_key: str,
    row_bytes: int,
    how: str = "inner",
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """Join with a table of unique keys: broadcast when its counted size allows, else split by hot keys."""
    if fits_broadcast(table, row_bytes, limits):
        return big.join(F.broadcast(table), F.col(big_key) == F.col(table_key), how)
    return salted_join(big, table, big_key, table_key, how, limits, (hot_keys(big, big_key, limits), None))
