"""Exact dedup over an extendible-hash index that is kept in shared files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.skew import skew_join
from ledgerlens.session import new_folder, shuffle_width, stored

#: Characters that don't count.
SPACES = " \t\n\x0b\x0c\r"
CAPACITY = 64 << 20  # bytes of a bucket
DEPTH = 20  # doublings of the directory at most
MAP_BITS = 1 << 27  # bits of the map of repeated keys
MAP_BLOCK = 1 << 15  # bits that Spark's bitmap functions keep in one row


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def hash_key(text: Column, bits: int) -> Column:
    """The first ``bits`` bits of a text's hash, in the upper bits of a long."""
    return F.xxhash64(text).bitwiseAND(F.lit(-1 << (64 - bits)))


def cell(key: Column, depth: int = DEPTH) -> Column:
    """Number of the directory cell of a key: its first ``depth`` bits."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


@dataclass
class HashIndex:
    """Tables of the index in shared files.

    ``entries`` has a row per document (row, id, key, n_chars, text_sha256), ``directory`` a row per cell
    of the directory (cell, low, depth: first key and local depth of the bucket it points to), and ``chains``
    the texts of keys that may repeat, by bucket (low, key, chain, text).
    """

    entries: DataFrame
    directory: DataFrame
    depth: int
    chains: DataFrame


def grow_directory(slots: DataFrame, capacity: int, folder: str) -> tuple[DataFrame, int]:
    """Directory over the keys of ``slots`` (key, load), and its global depth.

    It starts as one bucket. In each round the buckets that hold more than ``capacity`` bytes and more
    than one key are split by the next bit of their keys, which doubles the directory. A key alone
    can't be split, nor are buckets beyond ``DEPTH`` doublings: these overflow. Loads are summed to
    2 ** DEPTH cells once, so rounds don't read the keys, and the directory has at most as many rows.
    """
    cells = slots.groupBy(cell(F.col("key")).alias("cell")).agg(F.sum("load").alias("load"), F.count(F.lit(1)).alias("keys"))
    open_, settled, depth = stored(cells, f"{folder}/cells"), None, 0
    while True:
        prefix = F.shiftright("cell", DEPTH - depth)
        buckets = open_.groupBy(prefix.alias("prefix")).agg(F.sum("load").alias("load"), F.sum("keys").alias("keys"))
        full = (F.col("load") > capacity) & (F.col("keys") > 1) & F.lit(depth < DEPTH)
        buckets = stored(buckets.withColumns({"depth": F.lit(depth), "full": full}), f"{folder}/depth-{depth}")
        done = buckets.where("NOT full").select("prefix", "depth")
        settled = done if settled is None else settled.union(done)
        split = buckets.where("full").select(F.col("prefix").alias("_full"))
        if split.isEmpty():
            break
        # At most 2 ** DEPTH rows on either side.
        open_ = open_.join(F.broadcast(split), prefix == F.col("_full"), "left_semi")
        depth += 1
    below = F.expr(f"shiftleft(1L, {depth} - depth)")
    pointers = settled.withColumn("cell", F.explode(F.sequence(F.col("prefix") * below, (F.col("prefix") + 1) * below - 1)))
    low = F.when(F.col("depth") > 0, F.expr("shiftleft(prefix, 64 - depth)")).otherwise(0).cast("long")
    return stored(pointers.select("cell", low.alias("low"), "depth"), f"{folder}/directory"), depth


def _map(keys: DataFrame) -> DataFrame:
    """(place, bits): a bit map of keys, of 16 MB whatever their number."""
    # Both functions count from 1.
    bit = _bit("key") + 1
    rows = keys.select(F.bitmap_bucket_number(bit).alias("place"), F.bitmap_bit_position(bit).alias("bit"))
    return rows.groupBy("place").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _bit(key: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(MAP_BITS))


def _in_map(bits: Column, key: str) -> Column:
    at = F.pmod(_bit(key), F.lit(MAP_BLOCK))
    byte = F.conv(F.hex(F.substr(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1, F.lit(False))


def _keyed(docs: DataFrame, id_col: str, text_col: str, bits: int) -> DataFrame:
    """(id, n_chars, norm, key) of every row."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_chars"), normalised(F.col(text_col)).alias("norm")
    )
    return rows.withColumn("key", hash_key(F.col("norm"), bits))


def _entries(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.monotonically_increasing_id().alias("row"), "id", "key", "n_chars", F.octet_length("norm").alias("bytes"), F.sha2("norm", 256).alias("text_sha256")
    )


def build_index(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, bits: int = 64) -> HashIndex:
    """Write the index of all rows of ``docs`` below ``folder``.

    Texts of keys that occur once stay where they are: a bit map of the repeated keys keeps them away from the
    shuffle (it may let some through, which makes them chains of one). Copies are put together by their
    bytes before they move, so a text that very many rows share reaches its owner once. An owner
    is the task of a range of (bucket, key); it chains the texts that share a key.
    """
    rows = _keyed(docs, id_col, text_col, bits)
    entries = stored(_entries(rows), f"{folder}/entries")
    slots = entries.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))
    slots = stored(slots.where("rows > 1").select("key", (F.col("bytes") + 64).alias("load")), f"{folder}/slots")
    directory, depth = grow_directory(slots, capacity, folder)
    shared = stored(_map(slots), f"{folder}/map")
    # Bounded: MAP_BITS / MAP_BLOCK rows of 4 KB, and 2 ** DEPTH rows.
    place = F.bitmap_bucket_number(_bit("key") + 1)
    texts = rows.select("key", "norm", place.alias("place")).join(F.broadcast(shared), "place")
    texts = texts.where(_in_map(F.col("bits"), "key")).select("key", "norm").distinct()
    owned = texts.withColumn("cell", cell(F.col("key"), depth)).join(F.broadcast(directory), "cell", "left")
    owned = owned.select(F.coalesce("low", F.lit(0)).alias("low"), "key", "norm")
    owned = owned.repartitionByRange(shuffle_width(docs.sparkSession), "low", "key")
    chain = F.row_number().over(Window.partitionBy("low", "key").orderBy("norm"))
    chains = stored(owned.withColumn("chain", chain).select("low", "key", "chain", F.col("norm").alias("text")), f"{folder}/chains")
    return HashIndex(entries, directory, depth, chains)


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, bits: int = 64) -> DataFrame:
    """Group every row of ``docs`` with the rows whose text is equal but for ASCII white space.

    Returns one row per row: the id, keep_id, group_size, kept, text_sha256 (of the text without
    white space). Of a group the row with the most code points in its text stays, then the one of
    the smallest id (null ids last); of equal rows that tie in both exactly one stays. Null texts count as
    empty, and form one group with empty and blank ones. Very long texts are compared whole. An
    empty table gives no rows. Other columns are not read.

    Rows whose key has one text belong together. Where the chain of a key holds several texts, rows
    are compared with them byte by byte. Groups are summed before their shuffle, and rows
    of heavy groups are spread over several tasks. ``bits`` shortens the keys, for tests.
    """
    folder = new_folder(docs.sparkSession, "exact_dedup")
    index = build_index(docs, folder, id_col=id_col, text_col=text_col, capacity=capacity, bits=bits)
    crowded = stored(index.chains.where("chain > 1").select("key").distinct(), f"{folder}/crowded")
    columns = ["row", "id", "key", "n_chars", "text_sha256"]
    alone = index.entries.join(crowded, "key", "left_anti").select(*columns, F.lit(1).alias("chain"))
    texts = index.chains.join(crowded, "key", "left_semi").select("key", F.col("text").alias("norm"), "chain")
    collided = _keyed(docs, id_col, text_col, bits).join(crowded, "key", "left_semi").join(texts, ["key", "norm"])
    collided = stored(collided.select(F.monotonically_increasing_id().alias("row"), "id", "key", "n_chars", F.sha2("norm", 256).alias("text_sha256"), "chain"), f"{folder}/collided")
    members = alone.unionByName(collided)
    best = F.min(F.struct((-F.col("n_chars")).alias("c"), F.col("id").isNull().alias("u"), "id", "row")).alias("best")
    groups = members.groupBy("key", "chain").agg(F.count(F.lit(1)).alias("size"), best)
    groups = stored(groups.where("size > 1").select("key", "chain", "size", F.col("best.id").alias("first"), F.col("best.row").alias("stays")), f"{folder}/groups")
    out = skew_join(members, groups, ["key", "chain"], "left", left_spread=["row"])
    alone = F.col("size").isNull()
    return out.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("first")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("row") == F.col("stays"))).alias("kept"), "text_sha256",
    )
