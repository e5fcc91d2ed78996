"""Bounded training samples taken by hash, so that they don't depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 1_000_000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def part_of(key: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(PARTS))


def about(rows: DataFrame, key: str, most: int, seed: int) -> Column:
    """Condition that leaves about ``most`` rows, all of them where there are fewer."""
    n = rows.count()
    return part_of(F.col(key), seed) < (PARTS if n <= most else int(PARTS * most / n))
