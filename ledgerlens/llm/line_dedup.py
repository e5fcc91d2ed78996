"""Line dedup: documents that share lines are aligned, and the later one loses the common blocks."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.text import let
from ledgerlens.session import durable, few_files

LEAST_WORDS = 8
#: Base of the keys of runs, odd and 3 modulo 4, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C1B
INVERSE = pow(BASE, -1, 1 << 64)


def _once(lines: list[int], a: int, b: int) -> dict[int, int]:
    """Places of the lines that occur once between a and b."""
    places: dict[int, int] = {}
    for i in range(a, b):
        places[lines[i]] = -1 if lines[i] in places else i
    return {line: i for line, i in places.items() if i >= 0}


def patience(x: list[int], y: list[int]) -> list[tuple[int, int]]:
    """Aligned places of two sequences, in order.

    Equal ends are matched first; between them, lines that occur once in both sequences are
    anchors where they keep their order (the longest such chain), and the gaps between anchors
    are aligned in the same way. A gap without anchors is left alone (``common_blocks`` sees to it).
    """
    found: list[tuple[int, int]] = []
    gaps = [(0, len(x), 0, len(y))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and x[a] == y[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and x[b - 1] == y[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        left, right = _once(x, a, b), _once(y, c, d)
        both = [(i, right[line]) for line, i in left.items() if line in right]  # by place in x
        tops: list[int] = []
        ends: list[int] = []
        before: list[int] = []
        for k, (_, j) in enumerate(both):
            pile = bisect_left(tops, j)
            before.append(ends[pile - 1] if pile else -1)
            tops[pile : pile + 1] = [j]
            ends[pile : pile + 1] = [k]
        chain, k = [], ends[-1] if ends else -1
        while k >= 0:
            chain.append(both[k])
            k = before[k]
        if chain:
            found += chain
            edges = [(b, d), *chain, (a - 1, c - 1)]
            gaps += [(lo[0] + 1, hi[0], lo[1] + 1, hi[1]) for hi, lo in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(found)


def shortest_runs(lines: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and keys of the shortest runs of ``least`` words from each line on, and up to each line.

    Document k has the lines from ``offsets[k]`` up to ``offsets[k + 1]``; runs stay within one. Every line of
    a block of ``least`` words lies in one of these runs inside of the block. Equal runs have equal keys.
    """
    n, least = len(lines), max(least, 1)
    words = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)])
    lengths = np.diff(offsets)
    first, stop = np.repeat(offsets[:-1], lengths), np.repeat(offsets[1:], lengths)
    places = np.arange(n)
    ends = np.searchsorted(words, words[:-1] + least, "left")
    starts = np.searchsorted(words, words[1:] - least, "right") - 1
    down, up = ends <= stop, starts >= first
    pairs = np.unique(np.concatenate([places[down] * (n + 1) + ends[down], starts[up] * (n + 1) + places[up] + 1]))
    starts, ends = np.divmod(pairs, n + 1)
    powers, inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (BASE, INVERSE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((lines.astype(np.int64).view(np.uint64) + np.uint64(BASE)) * powers[:n], dtype=np.uint64)])
    return starts, ends, ((sums[ends] - sums[starts]) * inverse[starts]).view(np.int64)


def _left_over(own: list[int], other: list[int], sizes: list[int], least: int, out: list[int]) -> set[int]:
    """Places in ``own`` of all common blocks, where lines besides ``out`` can lie in one."""
    held, gone = set(other), set(out)
    both = [line in held for line in own] + [False]
    if not any(both[i] and i not in gone and (sizes[i] >= least or both[i - 1] or both[i + 1]) for i in range(len(own))):
        return set()
    size = dict(zip(own, sizes, strict=True))
    starts, ends, keys = shortest_runs(np.array(own, np.int64), np.array(sizes), np.array([0, len(own)]), least)
    others = np.array([size.get(line, least) for line in other])
    common = np.isin(keys, shortest_runs(np.array(other, np.int64), others, np.array([0, len(other)]), least)[2])
    # a difference array, as runs over many blank lines overlap
    edges = np.bincount(starts[common], minlength=len(own) + 1) - np.bincount(ends[common], minlength=len(own) + 1)
    return set(np.flatnonzero(np.cumsum(edges)).tolist())


def common_blocks(own: list[int], other: list[int], sizes: list[int], least: int) -> list[int]:
    """Places in ``own`` of the lines in common blocks (neighbours in both) of ``least`` words or more.

    Patience diff aligns the two; blocks that it can't align (repeated in one of them, or in
    another order) are then found by their shortest runs of ``least`` words.
    """
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience(own, other), (-9, -9)]:
        if block and (i, j) != (last[0] + 1, last[1] + 1):
            if sum(sizes[k] for k in block) >= least:
                out += block
            block = []
        block.append(i)
        last = (i, j)
    return sorted(_left_over(own, other, sizes, least, out).union(out))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _runs(least: int):
    """Keys of the shortest runs of each document, with their spans: start and end as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, version, lines, sizes = batch.columns
            offsets = lines.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            starts, ends, keys = shortest_runs(lines.flatten().to_numpy(), sizes.flatten().to_numpy(), offsets, least)
            of = np.searchsorted(offsets, starts, "right") - 1
            spans = (starts - offsets[of]) << 32 | (ends - offsets[of])
            yield pa.record_batch([doc.take(pa.array(of)), version.take(pa.array(of)), pa.array(keys), pa.array(spans)], ["doc_id", "version", "run", "span"])

    return run


def _covered(spans: list[int]) -> Iterator[int]:
    """Places in any of the spans, each once."""
    upto = 0
    for span in sorted(spans):
        start, end = span >> 32, span & 0xFFFFFFFF
        yield from range(max(start, upto), end)
        upto = max(upto, end)


def _kept(gone: set[int], n: int) -> list[dict[str, int]]:
    """Runs of lines that stay of ``n``."""
    ends = [-1, *sorted(gone), n]
    return [{"at": a + 1, "n": b - a - 1} for a, b in zip(ends, ends[1:]) if b > a + 1]


def _aligned(least: int):
    """Removed lines and kept runs of each document, whose rows (one for each partner) follow each other."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, gone, own, sizes, done = None, set(), [], [], []

        def finished() -> pa.RecordBatch:
            rows = [(*key, len(g), _kept(g, n)) for key, g, n in done if g]
            done.clear()
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))
            return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["doc_id", "version", "removed", "kept"])

        for batch in batches:
            for doc, version, lines, words, spans, partner in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (doc, version) != current:
                    if current:
                        done.append((current, gone, len(own)))
                    current, gone, own, sizes = (doc, version), set(), lines, words
                if not all(i in gone for i in _covered(spans)):
                    gone.update(common_blocks(own, partner, sizes, least))
            yield finished()
        if current:
            done.append((current, gone, len(own)))
        yield finished()

    return align


def dedup_lines(docs: DataFrame, *, least_words: int = LEAST_WORDS) -> DataFrame:
    """Delete from every document the blocks of lines that it shares with earlier ones.

    Returns all columns of ``docs`` (doc_id, text among them; lines_removed of its own is replaced)
    with ``text`` joined from the lines that stay and ``lines_removed``. Lines end at ``\\n`` and
    are equal if all their characters are. Every shortest run of ``least_words`` words (from a line on, or up to a
    line) that several documents hold names its holder of smallest doc_id as partner of the others, so partners
    grow with lines, not with the square of a group, and every block that any earlier document holds has
    partners for all of its lines. A document meets its partners from the one that its rarest run names on; a
    partner is skipped once the runs that named it are gone. The two are aligned by patience
    diff, and common blocks of ``least_words`` words or more go, also those that are repeated or whose order
    crosses. Frequent runs are not cut off: that would lose large groups of copies.

    Texts are judged as given. Blank lines alone name nobody, but go inside a block. Null texts stay null with
    0 removed; empty texts, and rows with a null doc_id, stay as they are; a document
    of which all goes keeps its row with an empty text. Rows repeated under one doc_id aren't
    partners of each other, and each is judged by its own text. An empty table gives no rows.

    Only hashes of lines and runs are shuffled to find and align partners; counts and holders are summed
    before their shuffle, and the joins are ones that Spark can split at a hot run or holder.
    Texts move once, to lose their lines.
    """
    text = _lines(F.col("text"))
    version = F.xxhash64("text")
    sized = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", version.alias("version"),
        F.transform(text, lambda x: F.when(F.trim(x) == "", F.lit(0)).otherwise(F.xxhash64(x))).alias("lines"),
        F.transform(text, lambda x: F.when(F.trim(x) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(x), " +")))).alias("sizes"),
    )
    sized = durable(few_files(sized.dropDuplicates(["doc_id", "version"]), docs))
    runs = sized.select("doc_id", "version", "lines", "sizes").mapInArrow(_runs(least_words), "doc_id long, version long, run long, span long")
    holders = runs.groupBy("run").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    named = runs.join(holders.where("holder <> last").drop("last"), "run").where("doc_id <> holder")
    named = named.groupBy("doc_id", "version", "holder").agg(F.min("n").alias("rarity"), F.collect_list("span").alias("spans"))
    partners = sized.groupBy(F.col("doc_id").alias("holder")).agg(F.min_by("lines", "version").alias("partner"))
    pairs = named.join(partners, "holder").join(sized, ["doc_id", "version"])
    rows = pairs.repartition("doc_id").sortWithinPartitions("doc_id", "version", "rarity", "holder")
    removed = rows.select("doc_id", "version", "lines", "sizes", "spans", "partner").mapInArrow(
        _aligned(least_words), "doc_id long, version long, removed int, kept array<struct<at:int,n:int>>"
    )
    # names that no column of the documents has
    of, at, gone, runs = (F.col(f"line_dedup.{c}") for c in removed.columns)
    order = [c for c in docs.columns if c.lower() != "lines_removed"]
    joined = docs.alias("documents").join(removed.alias("line_dedup").hint("shuffle_hash"), (F.col("documents.doc_id") == of) & (F.xxhash64("documents.text") == at), "left")
    text = F.col("documents.text")
    # Runs of lines are cut out, which takes time by the lines, not by lines and removed lines.
    left = let(_lines(text), lambda lines: F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["at"] + 1, r["n"]))), "\n"))
    kept = F.when(gone.isNull() | text.isNull(), text).otherwise(left).alias("text")
    columns = [kept if c.lower() == "text" else F.col(f"documents.`{c}`") for c in order]
    return joined.select(*columns, F.coalesce(gone, F.lit(0)).alias("lines_removed"))
