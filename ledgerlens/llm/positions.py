"""Places of rows in the order of their group, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_width, stored


def same(left: DataFrame, right: DataFrame, columns: Sequence[str], names: Sequence[str]) -> Column:
    """Join condition: equal in all columns, nulls equal."""
    out = F.lit(True)
    for a, b in zip(columns, names, strict=True):
        out = out & left[a].eqNullSafe(right[b])
    return out


def with_positions(rows: DataFrame, group: Sequence[str], order: Sequence[str], folder: str) -> DataFrame:
    """``rows`` with ``at``, the place in the group from 0 by ``order`` (nulls first), and ``n``, its size.

    Rows are dealt to ranges of (group, order), so that one group spreads over many tasks, and written
    below ``folder`` with a running number. A group's rows in one range follow each other; each
    such run is shifted by the rows of the runs before it. Rows that tie get places in any order. The
    runs are as many as ranges and groups together; Spark broadcasts them below its bound.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys)
    numbered = stored(ranged.withColumn("_id", F.monotonically_increasing_id()), f"{folder}/numbered")
    numbered = numbered.withColumn("_range", F.shiftright("_id", 33))
    runs = numbered.groupBy(*group, "_range").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_range").alias("_r"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(whole).alias("n"),
    )
    runs = stored(runs, f"{folder}/runs")
    match = same(numbered, runs, [*group, "_range"], [*(f"_g{i}" for i in range(len(group))), "_r"])
    placed = numbered.join(runs, match).withColumn("at", F.col("_id") + F.col("_shift"))
    return placed.select(*rows.columns, "at", "n")
