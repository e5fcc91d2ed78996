"""Removal of long repeats with sharded suffix arrays kept in levels of geometric size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_width

from .hashing import mix, slices, text_bytes

LENGTH = 50
GRAM = 20
BATCH = 1 << 20
KEY_BITS = 8
SLICE = 4 << 20  # bytes of texts that a task takes together: each sends a packed array to every shard
STEP = 1 << 15
_BYTE = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(factor: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(STEP + 2 * LENGTH, factor, np.uint64))))


_FACTOR = 0x9E3779B97F4A7C15
_UP, _DOWN = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 2**64))


def _rolled(data: np.ndarray, size: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """``rolling`` of at most a step and some bytes: a difference of prefix sums, which wrap modulo 2**64."""
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = _BYTE[data]
    terms *= _DOWN[: len(data)]
    np.cumsum(terms, out=sums[1:])
    out = sums[size:] - sums[: len(sums) - size]
    out *= _UP[size - 1 : size - 1 + len(out)]
    return mix(out if wanted is None else out[wanted[: len(out)]])


def rolling(data: np.ndarray, size: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Hash of every run of ``size`` (at most 50) bytes, or of the ``wanted`` ones; wraps modulo 2**64 before it is mixed.

    Steps are so short that their arrays stay in a core's cache.
    """
    n, parts = len(data) - size + 1, [np.zeros(0, np.uint64)]
    for at in range(0, n, STEP):
        parts.append(_rolled(data[at : at + STEP + size - 1], size, None if wanted is None else wanted[at : at + STEP]))
    return np.concatenate(parts)


def _minima(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span < width:
        step = min(span, width - span)
        x = np.minimum(x[:-step], x[step:])
        span += step
    return x


def suffix_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, start, n): runs of suffixes of at least 50 bytes that share their smallest 20-gram.

    Two equal 50-byte strings have equal keys, so a key's suffixes can be compared apart from all
    others. ``start`` counts from the beginning of ``data``.
    """
    size = max(0, len(data) - LENGTH + 1)
    keys, new = np.empty(size, np.uint64), np.ones(size + 1, bool)
    for i in range(0, size, STEP):
        part = _minima(_rolled(data[i : i + STEP + LENGTH - 1], GRAM), LENGTH - GRAM + 1)
        keys[i : i + len(part)] = part
        np.not_equal(part[1:], part[:-1], out=new[i + 1 : i + len(part)])
        new[i] = not i or keys[i] != keys[i - 1]
    new[np.minimum(at[:-1], size)] = True
    new[np.clip(at[1:] - LENGTH + 1, 0, size)] = True  # what begins here reaches into the next row
    heads = np.flatnonzero(new[:size])
    row = np.searchsorted(at, heads, "right") - 1
    n = np.diff(np.append(heads, size))
    whole = heads + LENGTH <= at[row + 1]
    heads, row, n = heads[whole], row[whole], n[whole]
    return keys[heads], row, heads, n


class Levels:
    """Suffix arrays of earlier batches, each level at most half as long as the one before it.

    An array holds the fingerprints of the first 50 bytes of its suffixes in sorted order (equality
    is all that is asked of the order) with the smallest document of each.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Two arrays as one; ``b`` is the shorter."""
        place = np.searchsorted(a[0], b[0])
        near = np.minimum(place, len(a[0]) - 1)
        same = a[0][near] == b[0]
        docs = a[1].copy()
        docs[near[same]] = np.minimum(docs[near[same]], b[1][same])
        other = ~same
        at = place[other] + np.arange(other.sum())
        old = np.ones(len(a[0]) + len(at), bool)
        old[at] = False
        out = np.empty(len(old), np.uint64), np.empty(len(old), a[1].dtype)
        for i, (x, y) in enumerate(((a[0], b[0]), (docs, b[1]))):
            out[i][old], out[i][at] = x, y[other]
        return out

    def add(self, prints: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which suffixes of a batch match one of a smaller document, in it or in a level."""
        if not len(prints):
            return np.zeros(0, bool)
        order = np.argsort(prints)
        ranked, by = prints[order], docs[order]
        new = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        heads = np.flatnonzero(new)
        own = ranked[heads], np.minimum.reduceat(by, heads)
        least = own[1].copy()
        for level, before in self.levels:
            place = np.minimum(np.searchsorted(level, own[0]), len(level) - 1)
            least = np.where(level[place] == own[0], np.minimum(least, before[place]), least)
        found = np.empty(len(ranked), bool)
        found[order] = least[np.cumsum(new) - 1] < by
        self.levels.append(own)
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            a, b = self.levels.pop(), self.levels.pop()
            self.levels.append(self._merged(*sorted((a, b), key=lambda x: -len(x[0]))))
        return found


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of byte ranges by document; ranges that touch become one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    rank = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    shift = rank * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    new = np.ones(len(doc), bool)
    new[1:] = (start + shift)[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(doc)) - 1
    return doc[heads], start[heads], reach[last] - shift[last]


def _by_doc(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Rows (doc_id, spans): pairs of int64, as bytes."""
    doc, start, end = _spans(doc, start, end)
    ids, heads = np.unique(doc, return_index=True)
    both = np.stack((start, end), 1).astype(np.int64)
    cuts = np.append(heads, len(doc))
    return pa.record_batch([pa.array(ids, pa.int64()), pa.array([both[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())], ["doc_id", "spans"])


def _small(data: bytes) -> bytes:
    return len(data).to_bytes(8, "big") + pa.compress(data, codec="zstd", asbytes=True)


def _large(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "big"), codec="zstd", asbytes=True)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of int64 of one length, one after the other."""
    return _small(np.stack(columns).astype(np.int64).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    """Rows of three int64."""
    return np.frombuffer(_large(data), np.int64).reshape(3, -1).T


def _bundles(doc: np.ndarray, start: np.ndarray, end: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Ranges packed by groups of documents, so that their number follows the tasks, not the documents."""
    group = (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.searchsorted(group[order], np.arange(shards + 1))
    used = np.flatnonzero(np.diff(cuts))
    packed = [_packed(doc[p], start[p], end[p]) for p in (order[cuts[g] : cuts[g + 1]] for g in used)]
    none = pa.nulls(len(used), pa.binary())
    yield pa.record_batch([pa.array(used, pa.int32()), pa.array(packed, pa.binary()), none, none], ["shard", "known", "heads", "data"])


def _ids(part: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    part = part.filter(pa.compute.is_valid(part.column(0)))
    return part, part.column(0).to_numpy()


class KeyFilter:
    """Bloom filter of 48-bit keys, a part for each shard of ``KEY_BITS`` bits a key, so that it never fills."""

    def __init__(self, shards: int, parts: list[tuple[int, bytes]]) -> None:
        self.begin, self.size = np.zeros(shards, np.uint64), np.zeros(shards, np.uint64)
        sizes = [len(data) for _, data in parts]
        for (shard, data), end in zip(parts, np.cumsum(sizes).tolist(), strict=True):
            self.begin[shard], self.size[shard] = 8 * (end - len(data)), 8 * len(data)
        self.bits = np.frombuffer(b"".join(data for _, data in parts), np.uint8)

    @staticmethod
    def _places(keys: np.ndarray, size) -> Iterator[np.ndarray]:
        """Four places of every key below ``size`` (at most 2**32)."""
        h = mix(keys ^ np.uint64(_FACTOR))
        low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)
        for i in range(4):
            yield ((low + np.uint64(i) * high & np.uint64(0xFFFFFFFF)) * size) >> np.uint64(32)

    @classmethod
    def part(cls, keys: np.ndarray) -> bytes:
        """The bits of one shard's distinct keys."""
        bits = np.zeros(min(2**32, max(8, -(-len(keys) * KEY_BITS // 8) * 8)), np.uint8)
        for place in cls._places(keys, np.uint64(len(bits))):
            bits[place.astype(np.int64)] = 1
        return np.packbits(bits, bitorder="little").tobytes()

    def holds(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Whether each key may be one of its shard's; others pass as often as two or three in a hundred times."""
        size, begin = self.size[shard], self.begin[shard]
        found = size > 0
        for place in self._places(keys, size):
            place = np.where(size > 0, begin + place, np.uint64(0))
            found &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool) if len(self.bits) else False
        return found


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Shard of every key, the shards used, and the places of each one's keys."""
    shard = (keys % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    used = np.flatnonzero(np.diff(cuts))
    return shard, used, [order[cuts[s] : cuts[s + 1]] for s in used]


def _repeated_keys(docs: DataFrame, shards: int) -> KeyFilter:
    """Filter of the keys that occur in several documents.

    A task sends a key of a run of texts once, by shard, in packed arrays; a shard's keys meet in one task, which
    alone makes their part of the filter.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            part, ids = _ids(part)
            keys, row, _, _ = suffix_runs(*text_bytes(part.column(1)))
            if not len(keys):
                continue
            order = np.argsort(keys)
            keys, doc = keys[order], ids[row[order]]
            heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            several = np.minimum.reduceat(doc, heads) < np.maximum.reduceat(doc, heads)
            keys = keys[heads]
            _, used, pick = _by_shard(keys, shards)
            short = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]  # six bytes tell keys of a shard apart
            yield pa.record_batch(
                [pa.array(used, pa.int32()), pa.array([short[p].tobytes() for p in pick], pa.binary()), pa.array([np.packbits(several[p]).tobytes() for p in pick], pa.binary())],
                ["shard", "keys", "several"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for batch in batches:
            for shard, k, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(k) // 6
                wide = np.zeros((n, 8), np.uint8)
                wide[:, 2:] = np.frombuffer(k, np.uint8).reshape(n, 6)
                keys, several = kept.setdefault(shard, ([], []))
                keys.append(wide.view(">u8").ravel().astype(np.uint64))
                several.append(np.unpackbits(np.frombuffer(s, np.uint8), count=n).astype(bool))
        for shard in list(kept):
            keys, several = map(np.concatenate, kept.pop(shard))
            twice = np.sort(keys)
            found = np.unique(np.concatenate((twice[1:][twice[1:] == twice[:-1]], keys[several])))
            if len(found):
                yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([KeyFilter.part(found)], pa.binary())], ["shard", "bits"])

    sent = docs.mapInArrow(send, "shard int, keys binary, several binary").repartitionById(shards, "shard")
    return KeyFilter(shards, [(r["shard"], bytes(r["bits"])) for r in sent.mapInArrow(meet, "shard int, bits binary").collect()])


def _repeats(docs: DataFrame, seen, shards: int) -> DataFrame:
    """(doc_id, spans) with the removed byte ranges of every document that has some."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            part, ids = _ids(part)
            data, at = text_bytes(part.column(1))
            keys, row, start, n = suffix_runs(data, at)
            some = seen.value.holds(keys & np.uint64((1 << 48) - 1), (keys % np.uint64(shards)).astype(np.int64))
            keys, row, start, n = keys[some], row[some], start[some], n[some]
            if not len(keys):
                continue
            doc, from_ = ids[row], start - at[row]
            # copies of a run within these texts are settled here, so that hot passages are sent once
            leader = np.arange(len(doc))
            _, same, times = np.unique(keys, return_inverse=True, return_counts=True)
            again = np.flatnonzero(times[same] > 1)
            first: dict[bytes, int] = {}
            for i in again[np.argsort(doc[again], kind="stable")].tolist():
                leader[i] = first.setdefault(data[start[i] : start[i] + n[i] + LENGTH - 1].tobytes(), i)
            repeat = doc[leader] < doc
            known, begin, end = _spans(doc[repeat], from_[repeat], (from_ + n + LENGTH - 1)[repeat])
            yield from _bundles(known, begin, end, shards)
            lead = np.flatnonzero(~repeat)
            _, used, pick = _by_shard(keys[lead], shards)
            pick = [lead[p] for p in pick]
            heads = [_packed(doc[p], from_[p], n[p]) for p in pick]
            texts = [_small(b"".join([data[i:j].tobytes() for i, j in zip(start[p].tolist(), (start[p] + n[p] + LENGTH - 1).tolist(), strict=True)])) for p in pick]
            yield pa.record_batch([pa.array(used, pa.int32()), pa.nulls(len(used), pa.binary()), pa.array(heads, pa.binary()), pa.array(texts, pa.binary())], ["shard", "known", "heads", "data"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, texts, found = [np.zeros((0, 3), np.int64)], [], []
        for batch in batches:
            for known, h, t in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                if known is not None:
                    found.append(_unpacked(known))
                else:
                    heads.append(_unpacked(h))
                    texts.append(_large(t))
        heads, data = np.concatenate(heads), np.frombuffer(b"".join(texts), np.uint8)
        widths = heads[:, 2] + LENGTH - 1
        begins = np.cumsum(widths) - widths
        order = np.argsort(heads[:, 0], kind="stable")
        sizes = np.cumsum(heads[order, 2])
        index, a = Levels(), 0
        while a < len(order):
            b = int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + BATCH, "right"))
            b = int(np.searchsorted(heads[order, 0], heads[order[max(a, b - 1)], 0], "right"))  # whole documents
            run = order[a:b]
            n = heads[run, 2]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            buffer = np.concatenate([data[begins[i] : begins[i] + widths[i]] for i in run])
            wanted = np.repeat(np.arange(2 * len(run)) % 2 == 0, np.stack((n, np.full(len(n), LENGTH - 1)), 1).ravel())
            prints = rolling(buffer, LENGTH, wanted)
            doc, start = np.repeat(heads[run, 0], n), np.repeat(heads[run, 1], n) + inner
            hit = index.add(prints, doc)
            found.append(np.stack(_spans(doc[hit], start[hit], start[hit] + LENGTH), 1))
            a = b
        found = np.concatenate([np.zeros((0, 3), np.int64), *found])
        yield from _bundles(found[:, 0], found[:, 1], found[:, 2], shards)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros((0, 3), np.int64), *(_unpacked(known) for batch in batches for known in batch.column(1).to_pylist())]
        yield _by_doc(*np.concatenate(found).T)

    bundle = "shard int, known binary, heads binary, data binary"
    hits = docs.mapInArrow(send, bundle).repartitionById(shards, "shard").mapInArrow(scan, bundle)
    return hits.select("shard", "known").repartitionById(shards, "shard").mapInArrow(gather, "doc_id long, spans binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Cut every byte covered by a 50-byte string that also starts in a document of smaller doc_id.

    Returns a row for each row of ``docs`` (doc_id, text): doc_id, n_bytes, spans (removed ranges,
    pairs of int64 as bytes), kept (the remaining bytes). Null texts count as empty, texts under
    50 bytes lose nothing, rows with a null doc_id neither lose bytes nor cause a loss, and rows
    repeated under one doc_id do not match each other. An empty table gives no rows; other
    columns are not read. Texts are judged as given, not as cut.

    Suffixes are sharded by the smallest 20-gram of their first 50 bytes. Keys that one document
    alone has are told apart by a filter of a byte a shared key and hardly ever sent with text. There is one shard a partition, so that
    the arrays that tasks send to shards stay few and long. A shard takes its
    suffixes batch by batch in the order of doc_id: each batch gets a suffix array, which is scanned against
    the levels that earlier batches left and then merged into them geometrically. Copies of a run of
    suffixes in the same task are settled there. The texts move once, to meet their ranges.
    """
    texts = docs.select("doc_id", "text")
    shards = shuffle_width(docs.sparkSession)
    seen = docs.sparkSession.sparkContext.broadcast(_repeated_keys(texts, shards))
    spans = _repeats(texts, seen, shards).withColumnRenamed("doc_id", "spans_of")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                data, at = text_bytes(part.column(1))
                removed, kept = [], []
                for i, found in enumerate(part.column(2).to_pylist()):
                    own, text = np.zeros((0, 2), np.int64), data[at[i] : at[i + 1]]
                    if found:
                        own = np.frombuffer(found, np.int64).reshape(-1, 2)
                        own = own[own[:, 1] <= len(text)]
                        _, start, end = _spans(np.zeros(len(own), np.int64), own[:, 0], own[:, 1])
                        own = np.stack((start, end), 1)
                    removed.append(own.tobytes())
                    cuts = [0, *own.ravel().tolist(), len(text)]
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(cuts[::2], cuts[1::2], strict=True)))
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(at)), pa.array(removed, pa.binary()), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    joined = texts.join(spans.hint("shuffle_hash"), F.col("doc_id") == F.col("spans_of"), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_bytes long, spans binary, kept binary")


