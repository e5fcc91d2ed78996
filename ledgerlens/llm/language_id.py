"""Language of a text by a small convolutional network over its bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import slices, text_bytes
from .sampling import PARTS, held_out, part_of

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row, n): all texts cut into windows of a fixed length, the last padded with zeros."""
    n = -(-np.diff(at) // WINDOW)
    row = np.repeat(np.arange(len(n)), n)
    start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
    own = np.minimum(np.diff(at)[row] - start, WINDOW)
    padded = np.concatenate((data, np.zeros(WINDOW, np.uint8)))
    cut = padded[(at[:-1][row] + start)[:, None] + np.arange(WINDOW)]
    cut[np.arange(WINDOW) >= own[:, None]] = 0
    return cut, row, own


@dataclass
class ByteNetwork:
    """Byte embedding, filters of several widths, max pooling over a window, softmax."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], seed: int) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        return cls(
            languages, rng.standard_normal((256, EMBEDDING)) * 0.5,
            [rng.standard_normal((w * EMBEDDING, FILTERS)) / np.sqrt(w * EMBEDDING) for w in WIDTHS],
            [np.zeros(FILTERS) for _ in WIDTHS],
            rng.standard_normal((len(WIDTHS) * FILTERS, len(languages))) * 0.1, np.zeros(len(languages)),
        )

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width, lookups (offset, table) that sum up to a filter's response.

        A filter is linear in the embedded bytes, so two neighbouring bytes need one lookup.
        """
        found = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            single = [(self.embedding @ weights[k * EMBEDDING : (k + 1) * EMBEDDING]).astype(np.float32) for k in range(width)]
            pairs = [(k, (single[k][:, None] + single[k + 1][None, :]).reshape(65536, FILTERS)) for k in range(0, width - 1, 2)]
            found.append(pairs + ([(width - 1, single[-1])] if width % 2 else []))
        return found

    def log_odds(self, cut: np.ndarray, tables: list[list[tuple[int, np.ndarray]]]) -> np.ndarray:
        """Log probabilities of every window."""
        pair = cut[:, :-1].astype(np.int32) * 256 + cut[:, 1:]
        pooled = []
        for width, lookups, bias in zip(WIDTHS, tables, self.bias, strict=True):
            n, total = WINDOW - width + 1, None
            for offset, table in lookups:
                places = (pair if len(table) > 256 else cut)[:, offset : offset + n]
                part = np.take(table, places, axis=0)
                total = part if total is None else np.add(total, part, out=total)
            pooled.append(np.tanh(total.max(1) + bias))
        return _log_softmax(np.concatenate(pooled, 1) @ self.out + self.out_bias)

    def train(self, cut: np.ndarray, target: np.ndarray, *, steps: int, batch: int, seed: int) -> None:
        """Adam on the cross entropy; a maximum passes its gradient to the place it was taken from."""
        rng = np.random.default_rng(seed)
        params = [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(cut), batch)
            x, y = cut[pick], target[pick]
            embedded, pooled, spots = self.embedding[x], [], []
            for width, weights, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
                patches = np.lib.stride_tricks.sliding_window_view(embedded.reshape(batch, -1), width * EMBEDDING, axis=1)[:, ::EMBEDDING]
                response = patches @ weights
                spots.append(response.argmax(1))
                pooled.append(np.tanh(np.take_along_axis(response, spots[-1][:, None], 1)[:, 0] + bias))
            joined = np.concatenate(pooled, 1)
            slope = np.exp(_log_softmax(joined @ self.out + self.out_bias))
            slope[np.arange(batch), y] -= 1
            slope /= batch
            back = slope @ self.out.T * (1 - joined * joined)
            grads = [np.zeros_like(self.embedding), [], [], joined.T @ slope, slope.sum(0)]
            for k, width in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                bytes_ = x[np.arange(batch)[:, None, None], spots[k][:, :, None] + np.arange(width)]
                patch = self.embedding[bytes_].reshape(batch, FILTERS, -1)
                grads[1].append(np.einsum("bfd,bf->df", patch, g))
                grads[2].append(g.sum(0))
                np.add.at(grads[0], bytes_, (g[:, :, None] * self.filters[k].T).reshape(batch, FILTERS, width, EMBEDDING))
            for i, (p, g) in enumerate(zip(params, [grads[0], *grads[1], *grads[2], *grads[3:]], strict=True)):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                p -= 0.01 * (1 - 0.9 * step / steps) * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def learn(docs: DataFrame, *, texts: int = 1500, per_text: int = 8, steps: int = 900, batch: int = 64, seed: int = 7) -> ByteNetwork | None:
    """Train on rows of ``docs`` (doc_id, text, lang) with a lang whose crc32 modulo 4 is not 2.

    About ``texts`` texts of each language, chosen by hash of doc_id, give up to ``per_text`` windows
    spread over the whole text; that bounds what reaches the driver. Without such rows there is
    no network.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    counts = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.lit(0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(PARTS, int(PARTS * texts / n))).otherwise(share)
    chosen = usable.where(part_of(F.col("doc_id"), seed) < share).select("doc_id", "lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found, row, _ = windows(*text_bytes(part.column(2)))
            _, heads, n = np.unique(row, return_index=True, return_counts=True)
            keep = np.concatenate([h + np.unique(np.linspace(0, m - 1, per_text).astype(int)) for h, m in zip(heads, n, strict=True)]) if len(heads) else heads
            taken = pa.array(row[keep])
            yield pa.record_batch([part.column(0).take(taken), part.column(1).take(taken), pa.array([w.tobytes() for w in found[keep]], pa.binary())], ["doc_id", "lang", "bytes"])

    got = chosen.mapInArrow(cut, "doc_id long, lang string, bytes binary").toPandas().sort_values(["doc_id", "bytes"], kind="stable")
    languages = sorted(counts)
    network = ByteNetwork.new(languages, seed)
    if len(got):
        samples = np.frombuffer(b"".join(got["bytes"]), np.uint8).reshape(-1, WINDOW)
        network.train(samples, np.array([languages.index(x) for x in got["lang"]]), steps=steps, batch=batch, seed=seed + 1)
    return network


def identified(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """All columns of ``docs`` but for lang_pred and score of its own, and these two.

    The windows of the whole text vote with their log probabilities, weighted by their bytes.
    ``score`` is the resulting probability of ``lang_pred``. Null texts and texts without a letter
    are ``und`` with score 0, as are all without a network. Every row gives one row; there is no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net else None
        for part in slices(batches, "text", 1 << 18):
            column = part.column(part.schema.get_field_index("text"))
            data, at = text_bytes(column)
            letters = np.add.reduceat(np.append(_LETTERS[data], False), np.minimum(at[:-1], len(data))) * (np.diff(at) > 0)
            wordy = letters > 0
            for i in np.flatnonzero(~wordy & (np.diff(at) > 0)):
                wordy[i] = any(map(str.isalpha, column[int(i)].as_py()))
            langs, score = np.full(len(wordy), UNKNOWN, object), np.zeros(len(wordy))
            if net:
                found, row, own = windows(data, at)
                votes = np.zeros((len(wordy), len(net.languages)))
                for a in range(0, len(found), 128):  # what 128 windows need stays in the cache
                    b = slice(a, a + 128)
                    np.add.at(votes, row[b], net.log_odds(found[b], tables) * own[b, None])
                mean = np.exp(_log_softmax(votes / np.maximum(np.diff(at), 1)[:, None]))
                langs[wordy] = np.array(net.languages, object)[mean.argmax(1)[wordy]]
                score[wordy] = mean.max(1)[wordy]
            yield pa.record_batch([*(part.column(f.name) for f in kept), pa.array(langs, pa.string()), pa.array(score)], [*(f.name for f in kept), "lang_pred", "score"])

    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(*(f.name for f in kept)).mapInArrow(run, schema)


