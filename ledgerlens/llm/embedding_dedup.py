"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import durable

from .components import components

BUCKET = 256
BLOCK = 1024


def table_plan(rows: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables): about ``BUCKET`` rows to a bucket, and at most ``miss`` of pairs at the threshold lost."""
    bits = min(48, max(4, math.ceil(math.log2(max(1, rows) / BUCKET))))
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - together))


def _floats(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """The vectors of a list column; None for those that can't be compared."""
    values = column.values.cast(pa.float64())
    wrong = np.asarray(values.is_null())
    flat = values.fill_null(0.0).to_numpy(zero_copy_only=False)
    at = column.offsets.to_numpy()
    for i, ok in enumerate(np.asarray(column.is_valid())):
        x = flat[at[i] : at[i + 1]]
        yield x if ok and not wrong[at[i] : at[i + 1]].any() and np.isfinite(x).all() and x.any() else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column(2).to_pylist()
        keys = [
            None if x is None or label is None else hashlib.blake2b(f"{label},{len(x)},".encode() + x.tobytes(), digest_size=16).digest()
            for x, label in zip(_floats(batch.column(1)), labels, strict=True)
        ]
        yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary())], ["vec_id", "copy"])


def _signer(bits: int, tables: int, seed: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            rows = [(i, x / np.linalg.norm(x / np.abs(x).max()) / np.abs(x).max()) for i, x in enumerate(_floats(batch.column(1))) if x is not None]
            for dim in sorted({len(x) for _, x in rows}):
                some = [(i, x) for i, x in rows if len(x) == dim]
                if dim not in planes:
                    planes[dim] = np.random.default_rng(seed + dim).standard_normal((dim, bits * tables))
                unit = np.array([x for _, x in some])
                signs = ((unit @ planes[dim] > 0).reshape(len(some), tables, bits) * weights).sum(2)
                part = batch.take(pa.array([i for i, _ in some]))
                yield pa.record_batch(
                    [part.column(0), part.column(2).cast(pa.int64()), part.column(3), pa.array(list(signs), pa.list_(pa.int64())), pa.array([x.tobytes() for x in unit], pa.binary())],
                    ["vec_id", "label", "copies", "signs", "unit"],
                )

    return sign


def _linked(threshold: float):
    """Exact links within groups of rows that are sorted by ``group``."""

    def solve(rows: list[tuple]) -> Iterator[tuple[int, int, int]]:
        for dim in {len(r[6]) for r in rows}:
            some = [r for r in rows if len(r[6]) == dim]
            ids, copies = np.array([r[4] for r in some]), np.array([r[5] for r in some])
            unit = np.frombuffer(b"".join(r[6] for r in some)).reshape(len(some), -1)
            labels, signs, block = np.array([r[3] for r in some]), np.array([r[7] for r in some]), np.array([r[8] for r in some])
            table, (low, high) = some[0][1], some[0][2]
            link = (unit @ unit.T >= threshold) & (labels[:, None] == labels[None, :])
            np.fill_diagonal(link, False)
            if low != high:
                link &= block[:, None] != block[None, :]
            a, b = np.nonzero(link)
            if not len(a):
                continue
            new = ~(signs[a, :table] == signs[b, :table]).any(1)  # earlier tables have counted the others
            counts = np.bincount(a[new], copies[b[new]], len(some)).astype(np.int64)
            least = np.arange(len(some))
            while True:  # smallest row reachable within the group
                before = least.copy()
                np.minimum.at(least, a, least[b])
                least = least[least]
                if (least == before).all():
                    break
            for i in np.flatnonzero(counts | (least != np.arange(len(some)))):
                yield int(ids[i]), int(ids[least[i]]), int(counts[i])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(found) -> pa.RecordBatch:
            found = list(found)
            return pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], ["a", "b", "n_links"])

        for batch in batches:
            c = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            for r in zip(c["group"], c["tab"], zip(c["p"], c["q"], strict=True), c["label"], c["vec_id"], c["copies"], c["unit"], c["signs"], c["block"], strict=True):
                if held and held[0][0] != r[0]:
                    yield out(solve(held))
                    held = []
                held.append(r)
        yield out(solve(held))

    return link


def near_vectors(vectors: DataFrame, *, threshold: float = 0.98, miss: float = 0.0005, seed: int = 11) -> DataFrame:
    """Links and components of ``vectors`` (vec_id, embedding, label) by cosine within equal labels.

    Returns one row for each input row: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable), kept. Vectors that are null, all zero, empty, or hold null or
    non-finite components, and those with a null label, link with nothing; vectors of different
    lengths do not link. Rows with a null vec_id are not compared and get null component and
    kept; one vec_id repeated with the same vector counts once. An empty table gives no rows.

    Copies of a vector stand as one row with their number. The number of bits and tables follows
    from the number of rows and ``miss``, the expected share lost of pairs exactly at the
    threshold. Buckets of more than 1,024 rows are cut into blocks, and each pair of blocks is a
    group of its own, so no task holds a hot bucket. Groups give sums and spanning links, not pairs;
    a pair that meets in several tables counts in the first.
    """
    rows = vectors.select("vec_id", "embedding", "label")
    keyed = durable(rows.mapInArrow(_digests, "vec_id long, copy binary"))
    distinct = keyed.where("copy IS NOT NULL AND vec_id IS NOT NULL").distinct()
    classes = durable(distinct.groupBy("copy").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    bits, tables = table_plan(classes.count(), threshold, miss)
    heads = classes.select(F.col("first").alias("vec_id"), "copies")
    signed = rows.join(heads, "vec_id").mapInArrow(
        _signer(bits, tables, seed), "vec_id long, label long, copies long, signs array<long>, unit binary"
    )
    signed = durable(signed.dropDuplicates(["vec_id"]))
    placed = signed.select("*", F.posexplode("signs").alias("tab", "sign"))
    sizes = placed.groupBy("tab", "label", "sign").count().where("count > 1")
    met = placed.join(sizes, ["tab", "label", "sign"])
    met = met.withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    met = met.withColumn("group", F.xxhash64("tab", "label", "sign", "p", "q"))
    met = met.select("group", "tab", "p", "q", "label", "vec_id", "copies", "unit", "signs", "block")
    links = durable(met.repartition("group").sortWithinPartitions("group").mapInArrow(_linked(threshold), "a long, b long, n_links long"))
    joined = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("n_links").alias("n"))
    classes = classes.join(counts, classes["first"] == counts["a"], "left").join(joined, F.col("first") == F.col("node"), "left").select(
        "copy", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id")
    )
    known = keyed.join(classes, "copy", "left").withColumn("component_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id")))
    n_links = F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0)
    return known.select("vec_id", n_links.cast("long").alias("n_links"), "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
