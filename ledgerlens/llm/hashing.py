"""Word and shingle hashes of Arrow text columns, and small arrays gathered over all tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 14
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_random = np.random.default_rng(20240607)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all of their bits count."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x ^= x >> np.uint64(33)
    x *= _MIX[1]
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``size`` bytes of text; a longer text stands alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        _, at = text_bytes(column)
        row = 0
        while row < batch.num_rows:
            upto = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
            yield batch.slice(row, upto - row)
            row = upto


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (run of bytes other than ASCII white space), and the rows' word offsets."""
    global _PLACE
    letters = ~_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[at[:-1]] = True
    first = letters & (begins[:-1] | np.concatenate(([True], ~letters[:-1])))
    place = np.flatnonzero(letters)
    if not len(place):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    heads = np.flatnonzero(first[place])
    lengths = np.diff(np.append(heads, len(place)))
    inner = np.arange(len(place)) - np.repeat(heads, lengths)
    if lengths.max() > len(_PLACE):
        more = np.random.default_rng(1).integers(1, 2**63, int(lengths.max()), dtype=np.uint64) | np.uint64(1)
        more[: len(_PLACE)] = _PLACE[: len(more)]
        _PLACE = more
    hashes = mix(np.add.reduceat(_BYTE[data[place]] * _PLACE[inner], heads) + lengths.astype(np.uint64))
    return hashes, np.searchsorted(place[heads], at)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size``-word shingles by row, sorted within it, and the rows' offsets.

    A row of fewer words, but not none, has the whole sequence as its only shingle.
    """
    words, bounds = word_hashes(data, at)
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][row]
    width = np.minimum(counts, size)[row]
    total = width.astype(np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    for k in range(size):
        total = total + np.where(k < width, padded[start + k] * _PLACE[k], np.uint64(0))
    hashes = mix(total)
    ends = np.cumsum(n)
    for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True):
        hashes[a:b].sort()
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(counts) + 1))


def set_keys(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row's set of hashes, as int64; 0 for the empty set."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(hashes ^ _MIX[1]), dtype=np.uint64)))
    keys = mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)) | np.uint64(1)
    return np.where(np.diff(at) > 0, keys, np.uint64(0)).view(np.int64)


def blocks(array: np.ndarray) -> pa.RecordBatch:
    """An array as rows (block, packed data); blocks of zeros are left out."""
    parts = [(i, array[i * BLOCK : (i + 1) * BLOCK]) for i in range(-(-len(array) // BLOCK))]
    parts = [(i, pa.compress(p.tobytes(), codec="zstd", asbytes=True)) for i, p in parts if p.any()]
    return pa.record_batch([pa.array([i for i, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], ["block", "data"])


def gathered(parts: DataFrame, size: int, dtype: str, merge: Callable) -> np.ndarray:
    """Merge the (block, data) rows of all tasks into one array of a fixed size.

    Every reducing task holds one copy of its blocks; the driver gets ``size`` values.
    """

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                kept[i] = merge(kept[i], unpacked(i, data)) if i in kept else unpacked(i, data)
        packed = [pa.compress(v.tobytes(), codec="zstd", asbytes=True) for v in kept.values()]
        yield pa.record_batch([pa.array(list(kept), pa.int32()), pa.array(packed, pa.binary())], ["block", "data"])

    def unpacked(i: int, data: bytes) -> np.ndarray:
        n = min(BLOCK, size - i * BLOCK)
        return np.frombuffer(pa.decompress(data, n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)

    out = np.zeros(size, dtype)
    for i, data in parts.repartition("block").mapInArrow(combine, "block int, data binary").collect():
        part = unpacked(i, data)
        out[i * BLOCK : i * BLOCK + len(part)] = part
    return out


_ROUNDS = (np.uint64(0), np.uint64(0x9E3779B97F4A7C15))


def bit_places(values: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The two (byte, bit) places of every value."""
    for salt in _ROUNDS:
        place = mix(values.astype(np.int64).view(np.uint64) ^ salt) & np.uint64(bits - 1)
        yield (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)


def set_bits(array: np.ndarray, values: np.ndarray) -> None:
    for byte, bit in bit_places(values, len(array) * 8):
        np.bitwise_or.at(array, byte, bit)


def bitmap(values: DataFrame, bits: int = 1 << 24) -> np.ndarray:
    """A Bloom filter of the one long column of ``values``: 2 MB, whatever their number.

    Used to keep most rows that a join would lose away from its shuffle; the join decides.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            set_bits(own, batch.column(0).drop_null().to_numpy(zero_copy_only=False))
        yield blocks(own)

    return gathered(values.mapInArrow(local, "block int, data binary"), bits // 8, "uint8", np.bitwise_or)


def in_bitmap(array: np.ndarray, values: np.ndarray) -> np.ndarray:
    found = np.ones(len(values), bool)
    for byte, bit in bit_places(values, len(array) * 8):
        found &= (array[byte] & bit) > 0
    return found
