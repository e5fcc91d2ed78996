"""Merkle tree over a dataset, its levels kept as strings of concatenated digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import new_folder, stored

from .positions import same, with_positions

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 64  # hex digits of a digest
RUN = 8  # nodes under one parent
LEVELS = 3  # levels that a block climbs
BLOCK = RUN**LEVELS


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values in order: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _cut(level: Column, start: Column, stop: Column) -> Column:
    """Digests ``start`` up to ``stop`` of a level, fewer where it ends."""
    return F.substr(level, start * WIDTH + 1, (stop - start) * WIDTH)


def _parents(level: Column) -> Column:
    """The level above: the digest of every fixed-width substring of ``RUN`` digests."""
    runs = F.ceil(F.octet_length(level) / F.lit(WIDTH * RUN)).cast("int")
    digests = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_cut(level, i * RUN, (i + 1) * RUN), 256))
    return F.array_join(digests, "").cast("binary")


def _climbs(level: str) -> Column:
    """Whether a block's level is hashed again: others wait beside the block, or nodes in it."""
    return (F.col("n") > BLOCK) | (F.octet_length(level) > WIDTH)


def _siblings(level: str, step: int, at: Column) -> Column:
    """Array of the one (left, right) segment around node ``at >> 3 * step`` of a level; none where it stops."""
    place = F.shiftright(at, 3 * step)
    begin = F.shiftleft(F.shiftright(place, 3), 3)
    cut = F.struct(
        _cut(F.col(level), begin, place).cast("string").alias("left"), _cut(F.col(level), place + 1, begin + RUN).cast("string").alias("right")
    )
    return F.when(_climbs(level), F.array(cut)).otherwise(F.filter(F.array(cut), lambda _: F.lit(False)))


def _climbed(nodes: DataFrame, group: Sequence[str], carry: Sequence[str], folder: str) -> DataFrame:
    """One row per aligned block of ``nodes`` (group, at, n, digest, carry).

    l0, l1 and l2 are its levels, each one string (as bytes, so that a substring is a slice), ``above``
    the path from its top to the root of the group and ``top`` that root. Blocks of a larger group
    are the nodes of the next round, so there are as many rounds as log 512 of the largest group.
    """
    blocks = nodes.groupBy(*group, "n", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("at", "digest", *carry))).alias("nodes")
    )
    blocks = blocks.withColumn("l0", F.array_join("nodes.digest", "").cast("binary"))
    for step in range(LEVELS):
        below = f"l{step}"
        blocks = blocks.withColumn(f"l{step + 1}", F.when(_climbs(below), _parents(F.col(below))).otherwise(F.col(below)))
    blocks = stored(blocks.withColumn("l3", F.col("l3").cast("string")), f"{folder}/blocks")
    path = "array<struct<left:string,right:string>>"
    if (blocks.agg(F.max("n")).first()[0] or 0) <= BLOCK:
        return blocks.withColumns({"above": F.array().cast(path), "top": F.col("l3")}).drop("l3")
    tops = blocks.where(F.col("n") > BLOCK).select(
        *group, F.col("block").alias("at"), F.ceil(F.col("n") / BLOCK).alias("n"), F.col("l3").alias("digest")
    )
    upper = _paths(_climbed(tops, group, [], f"{folder}/up"), group, [])
    names = [f"_g{i}" for i in range(len(group))]
    upper = upper.select(*(F.col(g).alias(x) for g, x in zip(group, names, strict=True)), F.col("at").alias("_at"), F.col("path").alias("above"), F.col("top"))
    upper = stored(upper, f"{folder}/above")
    joined = blocks.join(upper, same(blocks, upper, [*group, "block"], [*names, "_at"]), "left")
    return joined.select(
        *blocks.columns[:-1], F.coalesce("above", F.array().cast(path)).alias("above"), F.coalesce("top", "l3").alias("top")
    )


def _paths(blocks: DataFrame, group: Sequence[str], carry: Sequence[str], *more: str) -> DataFrame:
    """(group, at, digest, carry, path, top) of every node; path runs from it to the root of its group."""

    def node(x: Column, i: Column) -> Column:
        own = F.concat(*(_siblings(f"l{step}", step, i) for step in range(LEVELS)))
        return F.struct(*(x[c].alias(c) for c in ("at", "digest", *carry)), own.alias("own"))

    # The outer form adds no filter on the array, which would compute it twice.
    rows = blocks.select(*group, *more, "above", "top", F.explode_outer(F.transform("nodes", node)).alias("x"))
    return rows.select(*group, *more, *(F.col(f"x.{c}").alias(c) for c in ("at", "digest", *carry)), F.concat("x.own", "above").alias("path"), "top")


def manifest(
    docs: DataFrame, *, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id", carry: Sequence[str] = ()
) -> DataFrame:
    """Leaf, roots and inclusion path of every row of ``docs``.

    Leaves are digests of ``columns``. Per value of ``group`` they ascend by ``key`` and every 8
    nodes (the last run fewer) become one until a single node, the subroot, is left; subroots in order of
    their group likewise give the root. Returns one row per row: key, leaf, subroot, root, path
    (array of the left and right siblings, as strings of concatenated hex digests, from the leaf through
    the subroot to the root) and the columns in ``carry``. ``folded(leaf, path)`` is the root of
    an unchanged row.

    Nulls are values of their own in every column: a null key comes first in its group, the null group
    first among groups; empty texts differ from null ones. Rows that repeat a key are ordered by
    their leaf; equal rows are leaves each. Very long texts only enter their digest. An empty table has
    no rows and no root. Other columns are not read.

    Only digests are shuffled: rows get places by ranges of (group, key), blocks of 512 places hold
    their three levels as strings, and the tops of blocks are the nodes of the next round.
    """
    folder = new_folder(docs.sparkSession, "merkle_manifest")
    leaves = docs.select(F.col(key).alias("_key"), F.col(group).alias("_group"), leaf_digest(*(F.col(c) for c in columns)).alias("digest"), *(F.col(c).alias(f"_c_{c}") for c in carry))
    # Written first: finding the ranges reads them too, and would read the texts again.
    leaves = stored(leaves, f"{folder}/digests")
    kept = ["_key", *(f"_c_{c}" for c in carry)]
    placed = with_positions(leaves, ["_group"], ["_key", "digest"], f"{folder}/leaves")
    blocks = _climbed(placed, ["_group"], kept, f"{folder}/groups")
    roots = blocks.where("block = 0").select("_group", F.col("top").alias("digest"))
    roots = with_positions(roots, [], ["_group"], f"{folder}/roots")
    roots = _paths(_climbed(roots, [], ["_group"], f"{folder}/root"), [], ["_group"])
    roots = stored(roots.select(F.col("_group").alias("_of"), F.col("path").alias("_beyond"), F.col("top").alias("root")), f"{folder}/paths")
    rows = _paths(blocks.join(roots, same(blocks, roots, ["_group"], ["_of"])), [], kept, "_beyond", "root")
    return rows.select(
        F.col("_key").alias(key), F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
        F.concat("path", "_beyond").alias("path"), *(F.col(f"_c_{c}").alias(c) for c in carry),
    )
