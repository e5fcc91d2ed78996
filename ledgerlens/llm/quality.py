"""Quality classifier learnt from positive and unlabelled texts with non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import slices, text_bytes, word_hashes
from .sampling import about, held_out

ACCEPT = 0.3
_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\v\f", *"|!#$%&*.,;:?\"'-_/@<>=+~^\\", "()[]{}")
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _i, _group in enumerate(_GROUPS):
    _CLASS[list(_group.encode())] = _i
_CLASS[128:192] = len(_GROUPS) + 1
_CLASS[192:] = len(_GROUPS) + 2
CLASSES = len(_GROUPS) + 3
FEATURES = 2 * CLASSES + 9


def features(column: pa.Array) -> np.ndarray:
    """One row of numbers for every text, from the whole of it."""
    data, at = text_bytes(column)
    n, size = len(at) - 1, np.diff(at)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    words, bounds = word_hashes(data, at)
    count = np.diff(bounds)
    word_row = np.repeat(np.arange(n), count)
    order = np.lexsort((words, word_row))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (word_row[1:] != word_row[:-1])
    distinct = np.bincount(word_row[new], minlength=n)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
    twice = np.bincount(word_row[again], minlength=n)
    share, per_word = counts / np.maximum(size, 1)[:, None], counts / np.maximum(count, 1)[:, None]
    lines = counts[:, 4] + 1
    extra = np.stack(
        [np.log1p(size), np.log1p(count), distinct / np.maximum(count, 1), np.log1p(distinct), twice / np.maximum(count, 1),
         np.log1p(size / np.maximum(count, 1)), np.log1p(count / lines), np.log1p(lines), (count == 0).astype(float)], 1,
    )
    return np.concatenate((np.sqrt(share), np.minimum(per_word, 8.0), extra), 1)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.weights, np.clip((x - self.mean) / self.scale, -6, 6))[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; the risk's boundary lies at ``ACCEPT``."""
        return 1 / (1 + np.exp(-np.clip(self.margin(x) + np.log(ACCEPT / (1 - ACCEPT)), -60, 60)))


def _forward(weights: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, b, v, c = weights
    hidden = np.tanh(x @ w + b)
    return hidden, hidden @ v + c


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, *, least: int = 200, delta: float = 0.1) -> float:
    """Share of positives among unlabelled margins, by the best bin.

    Above a threshold the share of unlabelled rows is at least the prior times that of positives;
    the smallest ratio, with a deviation term for small bins, bounds the prior from above.
    """
    cuts = np.quantile(positive, np.linspace(0.02, 0.98, 97))
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(unlabelled)) + 1 / np.sqrt(len(positive)))
    usable = p * len(positive) >= min(least, len(positive) / 2)
    best = np.argmin(np.where(usable, (u + slack) / np.maximum(p, 1e-9), np.inf))
    return float(np.clip(u[best] / max(p[best], 1e-9), 0.02, 0.98))


def _train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, hidden: int, epochs: int, seed: int) -> list[np.ndarray]:
    """Minimise the non-negative unbiased risk with the sigmoid loss, by Adam."""
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    weights = [rng.standard_normal((d, hidden)) / np.sqrt(d), np.zeros(hidden), rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    batches = max(1, len(unlabelled) // 256)
    epochs = max(epochs, 1000 // batches)  # few texts are gone over more often

    def gradient(x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        h, _ = _forward(weights, x)
        back = slope[:, None] * weights[2] * (1 - h * h)
        return [x.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]

    for _ in range(epochs):
        us = np.array_split(rng.permutation(len(unlabelled)), batches)
        ps = np.array_split(rng.permutation(len(positive)), batches) if len(positive) >= batches else [rng.integers(0, len(positive), 64) for _ in us]
        for i, j in zip(ps, us, strict=True):
            xp, xu = positive[i], unlabelled[j]
            sp, su = (1 / (1 + np.exp(-np.clip(_forward(weights, x)[1], -40, 40))) for x in (xp, xu))
            negative = su.mean() - prior * sp.mean()  # risk of calling positives negative taken off
            dp, du = sp * (1 - sp) / len(xp), su * (1 - su) / len(xu)
            if negative >= 0:
                parts = (gradient(xp, -2 * prior * dp), gradient(xu, du))
            else:  # the estimate has gone below zero: walk back along the negative part alone
                parts = (gradient(xp, prior * dp), gradient(xu, -du))
            step += 1
            for k, w in enumerate(weights):
                g = parts[0][k] + parts[1][k] + 1e-4 * w
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w -= 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(positive: np.ndarray, unlabelled: np.ndarray, *, hidden: int = 24, epochs: int = 30, seed: int = 3) -> QualityModel:
    """A first model with an even prior ranks held-back rows; they give the prior of the second."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    rough = _train(p[::2], u[::2], 0.5, hidden=hidden, epochs=max(5, epochs // 3), seed=seed)
    prior = class_prior(_forward(rough, p[1::2])[1], _forward(rough, u[1::2])[1]) if len(p) > 1 and len(u) > 1 else 0.5
    return QualityModel(mean, scale, _train(p, u, prior, hidden=hidden, epochs=epochs, seed=seed + 1), prior)


def _collected(docs: DataFrame) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            yield pa.record_batch([part.column(0), pa.array(list(features(part.column(1)).astype(np.float32)), pa.list_(pa.float32()))], ["doc_id", "x"])

    got = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<float>").toPandas().sort_values("doc_id", kind="stable")
    return np.array(got["x"].tolist(), float).reshape(-1, FEATURES)


def learn(docs: DataFrame, labels: DataFrame, *, positives: int = 6000, unlabelled: int = 20000, seed: int = 3) -> QualityModel | None:
    """Learn from trusted positives of ``labels`` (doc_id, quality) and from the texts of ``docs``.

    About ``positives`` labelled rows and ``unlabelled`` texts, chosen by hash of doc_id, bound what
    reaches the driver. Positives have quality 1 and a doc_id whose crc32 modulo 5 is not 0; no
    other label is read. Without positives or texts there is no model.
    """
    trusted = labels.where((F.col("quality") == 1) & ~held_out(F.col("doc_id"), 5, 0)).select("doc_id").distinct()
    trusted = trusted.where(about(trusted, "doc_id", positives, seed))
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    ids = [r.doc_id for r in trusted.collect()]
    good = _collected(texts.where(F.col("doc_id").isin(ids))) if ids else np.zeros((0, FEATURES))
    web = _collected(texts.where(about(docs.select("doc_id"), "doc_id", unlabelled, seed + 1))) if len(good) else good
    return fit(good, web, seed=seed) if len(good) and len(web) else None


def scored(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """All columns of ``docs`` but for a ``score`` of its own, and the score of the whole text.

    Null texts count as empty, and empty texts have a score too. Every row gives one row,
    repeated and null ids included; without a model the score is 0.5. There is no shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name.lower() != "score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x = features(part.column(part.schema.get_field_index("text")))
            score = np.full(len(x), 0.5) if shared.value is None else shared.value.score(x)
            yield pa.record_batch([*(part.column(f.name) for f in kept), pa.array(score)], [*(f.name for f in kept), "score"])

    return docs.select(*(f.name for f in kept)).mapInArrow(run, T.StructType([*kept, T.StructField("score", T.DoubleType())]))


def accepted(score: Column) -> Column:
    return score >= ACCEPT
