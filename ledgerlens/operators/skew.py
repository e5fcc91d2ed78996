"""Joins and rankings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_bytes, durable, plan_bytes, shuffle_width


def _heavy_keys(df: DataFrame, on: Sequence[str], width: int, root: bool) -> DataFrame:
    """Keys above a fair share of one shuffle partition, with the number of splits each needs.

    A key is heavy when it holds more than 1/width of all rows, so there are fewer than
    ``width`` of them: the frame is safe to broadcast whatever the size of ``df``.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    share = F.col("_n") * F.lit(float(width)) / F.col("_total")
    splits = F.ceil(F.sqrt(share) if root else share).cast("int")
    return (
        counts.crossJoin(F.broadcast(total))
        .filter(share > 1)
        .select(*[F.col(c).alias(f"_k_{c}") for c in on], splits.alias("_splits"))
    )


def _with_splits(df: DataFrame, heavy: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    match = None
    for c in on:
        cond = df[c].eqNullSafe(heavy[f"_k_{c}"])
        match = cond if match is None else match & cond
    joined = df.join(F.broadcast(heavy), match, "left")
    return joined.withColumn(name, F.coalesce("_splits", F.lit(1))).drop(
        "_splits", *[f"_k_{c}" for c in on]
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    left_spread: Sequence[str],
    right_spread: Sequence[str] | None = None,
    left_keys: DataFrame | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """Equi join whose heavy left keys are spread over several tasks.

    Rows of a heavy left key get a slot from the hash of ``left_spread``; the matching right
    rows are copied to each slot. With ``right_spread`` (inner joins only) heavy right keys
    are split as well, which makes a grid of slots for keys that are heavy on both sides.
    ``left_keys`` / ``right_keys`` may name a cheaper frame with the same spread of keys, so
    that a derived side is not computed twice to count them.
    Slots come from stored columns, so a recomputed task gives the same rows. A right side
    that Spark will broadcast needs none of this: then nothing is shuffled by key.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    if right_spread and how != "inner":
        raise ValueError("only inner joins may split the right side")
    on = list(on)
    if plan_bytes(right) <= broadcast_bytes(left.sparkSession):
        return left.join(right, on, how)
    width = shuffle_width(left.sparkSession)
    root = right_spread is not None

    def slot(cols: Sequence[str], splits: str) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.col(splits)).cast("int")

    heavy_left = _heavy_keys(left if left_keys is None else left_keys, on, width, root)
    lhs = _with_splits(left, heavy_left, on, "_ls")
    rhs = _with_splits(right, heavy_left, on, "_ls")
    lhs = lhs.withColumn("_li", slot(left_spread, "_ls"))
    rhs = rhs.withColumn("_li", F.explode(F.sequence(F.lit(0), F.col("_ls") - 1))).drop("_ls")
    keys = [*on, "_li"]
    if right_spread:
        heavy_right = _heavy_keys(right if right_keys is None else right_keys, on, width, root)
        lhs = _with_splits(lhs, heavy_right, on, "_rs")
        rhs = _with_splits(rhs, heavy_right, on, "_rs")
        lhs = lhs.withColumn("_ri", F.explode(F.sequence(F.lit(0), F.col("_rs") - 1))).drop("_rs")
        rhs = rhs.withColumn("_ri", slot(right_spread, "_rs")).drop("_rs")
        keys.append("_ri")
    return lhs.drop("_ls").join(rhs, keys, how).drop("_li", "_ri")


def distinct_set(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Sorted array of distinct non-NULL values per key.

    Values are deduplicated on (keys, value) first, so a key with many repeated rows is
    reduced over many tasks and only its distinct values meet in one.
    """
    pairs = df.filter(F.col(value).isNotNull()).select(*keys, value).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(out))


GROUP_ROWS = 1_000_000  # rows of one group that a single task may sort


def ordered_rank(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    out: str,
    limit: int | None = None,
    *,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """1-based position of each row in its group.

    With ``limit`` only the first rows of each group are wanted and Spark prunes every task to
    that many before the shuffle. Without it groups are counted first, on ``sizes`` if a
    cheaper frame with at least as many rows per group is at hand. While the largest one has
    at most ``GROUP_ROWS`` rows a plain window ranks them; beyond that rows are range
    partitioned on (group, order), ranked inside each range, and shifted by the number of
    rows of the group in earlier ranges.
    """
    group = list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    if limit is not None:
        return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= limit)
    counted = (df if sizes is None else sizes).groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    if (counted.agg(F.max("_n")).first()[0] or 0) <= GROUP_ROWS:
        return df.withColumn(out, F.row_number().over(w))
    return _rank_by_ranges(df, group, order, out)


def _rank_by_ranges(df: DataFrame, group: list[str], order: Sequence[Column], out: str) -> DataFrame:
    width = shuffle_width(df.sparkSession)
    # Written once: the number of a range must not change between its uses.
    ranged = durable(
        df.repartitionByRange(width, *[F.col(c) for c in group], *order).withColumn(
            "_range", F.spark_partition_id()
        )
    )
    per_range = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    ranked = ranged.withColumn("_pos", F.row_number().over(inside))
    match = ranked["_range"] == offsets["_r"]
    for c in group:
        match = match & ranked[c].eqNullSafe(offsets[f"_g_{c}"])
    return (
        ranked.join(offsets, match, "inner")
        .withColumn(out, (F.col("_pos") + F.col("_offset")).cast("int"))
        .drop("_range", "_r", "_pos", "_offset", "_n", *[f"_g_{c}" for c in group])
    )
