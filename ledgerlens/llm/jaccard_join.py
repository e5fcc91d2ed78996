"""Jaccard join of word shingles with adaptive multi-match prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import durable, fewer_tasks, new_folder, plan_bytes, stored

from .components import components
from .hashing import bitmap, blocks, gathered, in_bitmap, set_keys, shingle_sets, slices, text_bytes

SHINGLE = 5
MATCHES = 4
SKETCH = 1 << 22
#: Longs of a parity bitmap, and the length of lists from which on it is compared.
BITS = [f"b{k}" for k in range(8)]
HOT = 16
#: Shingles that a document of n shingles posts when it asks for l matches.
PREFIX = "least(n{0}, n{0} - (3 * n{0} + 3) div 4 + l{0})"


def _sets(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(*text_bytes(batch.column(batch.schema.get_field_index(name))), SHINGLE)


def _cell(hashes: np.ndarray) -> np.ndarray:
    """Sketch cell of every shingle, from the upper bits of its hash."""
    return (hashes >> np.uint64(42)).astype(np.int64)


def parities(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """512 bits for each row's set: whether an odd number of its hashes falls on the bit.

    Bits in which two rows differ are no more than the hashes that only one of them has.
    """
    bits = np.zeros((len(at) - 1) * len(BITS), np.uint64)
    cell = hashes & np.uint64(64 * len(BITS) - 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    np.bitwise_xor.at(bits, row * len(BITS) + (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63)))
    return bits.view(np.int64).reshape(-1, len(BITS))


def _scan(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, node, n, parities) for every row, and a frequency sketch of all shingles, in one pass.

    ``node`` is a key of the set of shingles, null for the empty set: copies are one node.
    """
    own_columns, sketch_columns = ["doc_id", "node", "n", *BITS], ["block", "data"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int32)
        for part in slices(batches, "text", 1 << 19):
            hashes, at = _sets(part)
            np.add.at(counts, _cell(hashes), 1)
            keys, n = set_keys(hashes, at), np.diff(at)
            empty = pa.nulls(part.num_rows)
            bits = [pa.array(np.ascontiguousarray(b)) for b in parities(hashes, at).T]
            yield pa.record_batch([part.column(0), pa.array(keys, mask=n == 0), pa.array(n), *bits, empty.cast(pa.int32()), empty.cast(pa.binary())], own_columns + sketch_columns)
        own = blocks(counts)
        empty = pa.nulls(own.num_rows, pa.int64())
        yield pa.record_batch([empty] * len(own_columns) + own.columns, own_columns + sketch_columns)

    schema = ", ".join(f"{c} long" for c in own_columns) + ", block int, data binary"
    both = durable(docs.select("doc_id", "text").mapInArrow(scan, schema))
    sketch = gathered(both.where("block IS NOT NULL").select(*sketch_columns), SKETCH, "int32", np.add)
    return both.where("block IS NULL").select(*own_columns), sketch


def _excess(sketch: np.ndarray) -> np.ndarray:
    """Estimated documents per shingle of a sketch cell, beyond what rare shingles load it with."""
    usual = float(np.median(sketch))
    return np.maximum(0.0, sketch - usual - 4.0 * np.sqrt(usual) - 2.0).astype(np.float32)


def prefix_matches(weights: np.ndarray, base: int, needed: int) -> int:
    """Shared tokens to ask of a document whose shingles, rarest first, have these estimated lists.

    A prefix of ``base + l`` shingles costs the reading of their lists and, as a candidate must
    occur in l of them, at most their sum divided by l in verifications.
    """
    lists = np.cumsum(weights)
    choices = range(1, max(1, min(MATCHES, needed)) + 1)
    return min(choices, key=lambda k: lists[min(base + k, len(lists)) - 1] * (1.0 + len(weights) / (8.0 * k)))


def _postings(docs: DataFrame, sketch: np.ndarray, only: np.ndarray | None = None) -> DataFrame:
    """(token, node) for the prefix of every document; n, l and place too for tokens of a bitmap."""
    excess = docs.sparkSession.sparkContext.broadcast(_excess(sketch))
    seen = docs.sparkSession.sparkContext.broadcast(only)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 1 << 19):
            hashes, at = _sets(part)
            keys, n = set_keys(hashes, at), np.diff(at)
            needed, asked = -(-3 * n // 4), np.ones(len(n), np.int64)
            cost = excess.value[_cell(hashes)]
            row = np.repeat(np.arange(len(n)), n)
            for i in np.unique(row[cost > 0]):
                a, b = at[i], at[i + 1]
                order = np.argsort(cost[a:b], kind="stable")
                asked[i] = prefix_matches(cost[a:b][order], b - a - needed[i], needed[i])
                hashes[a:b] = hashes[a:b][order]
            place = np.arange(len(hashes)) - at[row]
            keep = place < np.minimum(n, n - needed + asked)[row]
            tokens, row, place = hashes[keep].view(np.int64), row[keep], place[keep]
            if seen.value is None:
                yield pa.record_batch([pa.array(tokens), pa.array(keys[row])], ["token", "node"])
                continue
            some = in_bitmap(seen.value, tokens)
            tokens, row, place = tokens[some], row[some], place[some]
            yield pa.record_batch(
                [pa.array(tokens), pa.array(keys[row]), pa.array(n[row]), pa.array(asked[row].astype(np.int32)), pa.array(place.astype(np.int32))],
                ["token", "node", "n", "l", "place"],
            )

    return docs.select("doc_id", "text").mapInArrow(post, "token long, node long" + (", n long, l int, place int" if only is not None else ""))


def _shared(docs: DataFrame, sketch: np.ndarray, most: int) -> DataFrame:
    """The postings of tokens that several nodes have; all nodes together have ``most`` postings or fewer."""
    tokens = _postings(docs, sketch).groupBy("token").agg(F.min("node").alias("least"), F.max("node").alias("last"))
    tokens = durable(fewer_tasks(tokens.where("least <> last").select("token"), most))
    some = _postings(docs, sketch, bitmap(fewer_tasks(tokens, tokens.count())))
    some = some.groupBy("token", "node").agg(*(F.max(c).alias(c) for c in ("n", "l", "place")))
    return fewer_tasks(some.join(tokens, "token"), most)


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, most: int, n_docs: int) -> DataFrame:
    """The pairs of nodes (a, b), ``most`` or fewer, whose texts have a similarity of 0.75 or more.

    A text is fetched once for each node, from its smallest doc_id, and only for nodes in a pair.
    Frames are written by tasks for their rows, texts compared by tasks for their bytes.
    """
    pairs = durable(fewer_tasks(pairs, most))
    n_pairs = pairs.count()
    pairs = fewer_tasks(pairs, n_pairs)
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    chosen = rows.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(nodes, "node")
    chosen = durable(fewer_tasks(chosen, n_docs))
    for end in ("a", "b"):
        pairs = pairs.join(chosen.select(F.col("node").alias(end), F.col("doc_id").alias(f"doc_{end}")), end)
    seen = docs.sparkSession.sparkContext.broadcast(bitmap(fewer_tasks(chosen.select("doc_id"), chosen.count())))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            yield batch.filter(pa.array(in_bitmap(seen.value, ids.fill_null(0).to_numpy()))) if len(ids) else batch

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text_a", 1 << 18):
                sides = [_sets(part, "text_a"), _sets(part, "text_b")]
                ends = [part.column(0).to_numpy(), part.column(1).to_numpy()]
                same = [set_keys(*s) == e for s, e in zip(sides, ends, strict=True)]
                (x, xs), (y, ys) = sides
                good = np.zeros(part.num_rows, bool)
                for i in np.flatnonzero(same[0] & same[1]):
                    p, q = x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]]
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    good[i] = 100 * common >= 75 * (len(p) + len(q) - common)
                yield pa.record_batch([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(good))

    texts = docs.select("doc_id", "text").mapInArrow(likely, "doc_id long, text string")
    # The same exchange of texts by id serves both sides, as long as nothing is renamed below it.
    one, two = texts.alias("one"), texts.alias("two")
    both = pairs.join(one, F.col("doc_a") == F.col("one.doc_id")).join(two, F.col("doc_b") == F.col("two.doc_id"))
    both = both.select("a", "b", F.col("one.text").alias("text_a"), F.col("two.text").alias("text_b"))
    two_texts = 2 * plan_bytes(docs) // max(n_docs, 1)
    return fewer_tasks(both.mapInArrow(links, "a long, b long"), n_pairs, min(4096, max(1, (16 << 20) // max(two_texts, 1))))


def _met(pairs: DataFrame, *more: str) -> DataFrame:
    """(node, node2, matches, more) of pairs of nodes that can be similar, from their shared tokens.

    Both prefixes keep one order of tokens. So a pair has as many matches as the shorter demand;
    nothing in common before its first match, and behind its last one no more than the shorter
    rest; and what lies behind both prefixes adds no more than the longer rest.
    """
    met = pairs.groupBy("node", "node2").agg(
        F.count(F.lit(1)).alias("matches"), *(F.max(c).alias(c) for c in ("n", "l", "n2", "l2", *more)),
        *(f(c).alias(f"{name}{c[5:]}") for c in ("place", "place2") for name, f in (("first", F.min), ("last", F.max))),
    )
    rest = f"greatest(n - {PREFIX.format('')}, n2 - {PREFIX.format('2')})"
    most = f"least(matches + {rest}, n - first, n2 - first2, matches + n - last - 1, matches + n2 - last2 - 1)"
    return met.where(f"matches >= least(l, l2) AND 4 * least(n, n2) >= 3 * greatest(n, n2) AND 7 * {most} >= 3 * (n + n2)").select("node", "node2", "matches", *more)


def _led(shared: DataFrame) -> DataFrame:
    """(a, b): every node with the hub that most of its tokens name, if they can be similar.

    The hub of a token is its node with the least part of tokens that no other node has. In a large
    group of near copies that is the one with the fewest changes, to which the others are as
    similar as they are to any, which makes one component of them without their pairs.
    """
    own = f"(count(*) - {PREFIX.format('')}) / n"
    central = shared.groupBy("node", "n", "l").agg(F.expr(own).alias("central")).select("node", "central")
    hubs = shared.select("token", "node").join(central, "node").groupBy("token").agg(F.max(F.struct("central", "node")).alias("hub"))
    named = shared.select("token", "node").join(hubs.select("token", F.col("hub.node").alias("node2")), "token")
    named = named.where("node <> node2").groupBy("node", "node2").count()
    best = named.groupBy("node").agg(F.max(F.struct("count", "node2")).alias("best")).select("node", "best.node2")
    other = shared.select("token", *(F.col(c).alias(f"{c}2") for c in ("node", "n", "l", "place")))
    met = _met(best.join(shared, "node").join(other, ["token", "node2"]))
    return met.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct()


def _mixed(shared: DataFrame, parts: DataFrame, rows: DataFrame) -> DataFrame:
    """The postings of tokens that nodes of several parts have.

    With the part, ``main`` (the part with most nodes of the token), ``nth`` (place among the
    node's tokens that are left) and, in long lists, the node's parities.
    """
    labelled = shared.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    tokens = labelled.groupBy("token", "part").count().groupBy("token").agg(
        F.max(F.struct("count", "part")).alias("most"), F.sum("count").alias("size"), F.count(F.lit(1)).alias("parts")
    )
    tokens = tokens.where("parts > 1").select("token", "size", F.col("most.part").alias("main"))
    left = labelled.join(tokens, "token")
    left = left.withColumn("nth", F.row_number().over(Window.partitionBy("node").orderBy("place")))
    bits = rows.where("node IS NOT NULL").groupBy("node").agg(*(F.max(b).alias(b) for b in BITS))
    hot = (F.when(F.col("size") > HOT, F.col(b)).otherwise(F.lit(0)).alias(b) for b in BITS)
    return left.join(bits, "node").select("token", "node", "n", "l", "place", "part", "main", "nth", *hot)


def _crossing(mixed: DataFrame) -> DataFrame:
    """(a, b, matches, part, part2): pairs of nodes of different parts that may link.

    One node of such a pair is not of the token's main part, so that part isn't set against itself.
    """
    two = mixed.select("token", *(F.col(c).alias(f"{c}2") for c in mixed.columns if c not in ("token", "main")))
    differ = " + ".join(f"bit_count({b} ^ {b}2)" for b in BITS)
    possible = F.expr(
        "part <> part2 AND (part2 = main OR node < node2) AND 4 * least(n, n2) >= 3 * greatest(n, n2) AND "
        "7 * (least(nth, nth2) + least(n - place, n2 - place2) - 1) >= 3 * (n + n2) AND "
        f"7 * ({differ}) <= n + n2"
    )
    pairs = mixed.where("part <> main").join(two, "token").where(possible)
    swapped = [F.when(F.col("node") < F.col("node2"), F.col(x)).otherwise(F.col(y)).alias(x) for c in ("node", "n", "l", "place", "part") for x, y in ((c, f"{c}2"), (f"{c}2", c))]
    return _met(pairs.select(*swapped), "part", "part2").withColumnsRenamed({"node": "a", "node2": "b"})


def similar_documents(docs: DataFrame) -> DataFrame:
    """Components of documents (doc_id, text) whose shingle sets have a Jaccard similarity of 0.75.

    Words are runs of other bytes than ASCII white space, A-Z lower-cased; a set holds the
    distinct 5-word shingles, or the whole sequence of a shorter text. Returns one row for each
    row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable). Null texts and
    texts without words have an empty set and link with nothing; rows with a null doc_id have
    n_shingles and a null component; rows repeated under one doc_id are judged by their texts
    and share their components. An empty table gives no rows. Other columns are not read.

    Method: shingles are ordered by estimated frequency (a sketch of fixed size, summed over all
    texts), then by hash. A document posts a prefix that is longer, and asks for as many shared
    tokens more, where the estimated lists are long. Copies are one node. Tokens of one node go.
    First a node is compared with the hub of most of its tokens (the node with the least part of
    tokens of its own), which joins large groups of near copies without their pairs; then only
    nodes of different components that share a token meet, under bounds by length, position, number
    of matches and what the prefixes leave, in long lists by the parities of all shingles too, and of
    those first one pair for each two components. Every pair is verified on its texts.
    """
    rows, sketch = _scan(docs)
    folder = new_folder(docs.sparkSession, "jaccard_join")
    n_docs, postings = rows.agg(F.count(F.lit(1)), F.sum(F.expr(f"least(n, n - (3 * n + 3) div 4 + {MATCHES})"))).first()
    shared = stored(_shared(docs, sketch, postings or 0), f"{folder}/shared")
    links = durable(_verified(_led(shared), rows, docs, n_docs, n_docs))
    mixed = _mixed(shared, durable(components(links, n_docs)), rows)
    mixed = stored(fewer_tasks(mixed, shared.count(), 1 << 17), f"{folder}/mixed")
    met = stored(_crossing(mixed), f"{folder}/met")
    n_met = met.count()
    # one pair for each two parts first: where it links, the others need not be looked at
    sides = [F.least("part", "part2").alias("p"), F.greatest("part", "part2").alias("q")]
    first = met.groupBy(*sides).agg(F.max(F.struct("matches", "a", "b")).alias("best")).select("best.a", "best.b")
    links = durable(links.union(_verified(first, rows, docs, n_met, n_docs)))
    merged = durable(components(links, n_docs + n_met))
    for end in ("a", "b"):
        met = met.join(merged.select(F.col("node").alias(end), F.col("component").alias(f"in_{end}")), end, "left")
    apart = F.coalesce("in_a", "a") != F.coalesce("in_b", "b")
    links = links.union(_verified(met.where(apart).select("a", "b"), rows, docs, n_met, n_docs))
    found = components(durable(links), n_docs + 2 * n_met)
    known = rows.where("node IS NOT NULL AND doc_id IS NOT NULL")
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("first")).join(found, "node", "left")
    nodes = nodes.withColumn("part", F.coalesce("component", "node"))
    least = nodes.groupBy("part").agg(F.min("first").alias("component_id"))
    placed = fewer_tasks(rows.join(nodes.join(least, "part").select("node", "component_id"), "node", "left"), n_docs)
    return placed.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
