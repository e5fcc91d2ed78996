"""SentencePiece models run by the tokenizers library."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import slices

SPACE = "▁"
#: Piece types of the model's protobuf.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Model types of the trainer section.
UNIGRAM, BPE = 1, 2
WORD = re.compile(f"[ {SPACE}]+[^ {SPACE}]*|[^ {SPACE}]+")
PLAIN = re.compile(f" [^ {SPACE}]+")
ROW = 64
PROBES = (
    "", " ", "  a  b", "The quick brown fox.", "Été à la plage,\nfaçade", "tab\there", "a" * 40,
    "漢字 한국어 \U0001f600", "<s> </s> <0x41> <unk>", "x" + " " * 23 + "y", "1234567890 %$#!",
)


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces whose join is a piece, the best-scored join first.

    Runs of the space marker share one score, and ties are taken from the left, so that a run
    grows at its left end: among them the pair with the longest left part comes first.
    """
    known = {p for p, _, kind in pieces if kind == NORMAL}
    ranked = []
    for piece, score, kind in pieces:
        if kind == NORMAL and len(piece) > 1:
            run = piece.strip(SPACE) == ""
            for i in range(1, len(piece)):
                left, right = piece[:i], piece[i:]
                if left in known and right in known:
                    ranked.append((-score, -i if run else 0, len(right) if run else 0, i, left, right))
    return [(left, right) for *_, left, right in sorted(ranked)]


def _proto(model: bytes):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def build(model: bytes, prefix: bool = True):
    """A tokenizers ``Tokenizer`` with the pieces, normaliser and fallback of a SentencePiece model.

    Without ``prefix`` it neither adds the model's leading space nor takes it away in decoding.
    """
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    proto = _proto(model)
    pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
    vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
    unknown = next(p for p, _, kind in pieces if kind == UNKNOWN)
    fallback = proto.trainer_spec.byte_fallback
    if proto.trainer_spec.model_type == BPE:
        core = models.BPE(vocab, _merges(pieces), unk_token=unknown, fuse_unk=True, byte_fallback=fallback)
    elif proto.trainer_spec.model_type == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in pieces], vocab[unknown], fallback)
    else:
        raise ValueError(f"model type {proto.trainer_spec.model_type} is neither unigram nor BPE")
    spec, steps = proto.normalizer_spec, []
    prefix = prefix and spec.add_dummy_prefix
    if spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(spec.precompiled_charsmap))
    if spec.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps.append(normalizers.Replace(" ", SPACE))
    if prefix:
        steps.append(normalizers.Prepend(SPACE))
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence([*undo, decoders.Strip(" ", 1, 0)] if prefix else undo)
    return tokenizer


class Codec:
    """Encodes texts, and tells whether their ids decode to them and are those of the sentencepiece library.

    Where a model leaves texts as they are and has no piece that crosses the start of a word, a
    text is encoded word by word (a word with the spaces before it), and each distinct word is
    given to the library once, many in a row and such rows in multithreaded batches; at most
    ``remembered`` words are kept from one batch to the next, with their ids as packed bytes. Other models get whole texts.
    """

    def __init__(self, model: bytes, remembered: int = 200_000) -> None:
        spec, pieces = _proto(model).normalizer_spec, _proto(model).pieces
        local = not (spec.precompiled_charsmap or spec.remove_extra_whitespaces)
        self.by_word = local and not any(SPACE in p.piece.lstrip(SPACE) for p in pieces if p.type == NORMAL)
        self.lead = " " if spec.add_dummy_prefix else ""
        self.library = build(model, prefix=not self.by_word)
        self.leads = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in pieces])
        self.remembered, self.ids, self.lossy, self.odd = remembered, {}, set(), set()
        self.other = sentencepiece.SentencePieceProcessor(model_proto=model)

    def _learn(self, texts: list[str]) -> tuple[list[list[int]], list[bool]]:
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.library.decode_batch(ids, skip_special_tokens=False)
        return ids, [a == b for a, b in zip(texts, back, strict=True)]

    def _remember(self, words: list[str]) -> None:
        """Words with one space before them go to the library in rows, cut again where a word starts."""
        plain, alone = [], []
        for w in words:
            (plain if PLAIN.fullmatch(w) else alone).append(w)
        rows = [plain[at : at + ROW] for at in range(0, len(plain), ROW)]
        joined, doubtful = ["".join(r) for r in rows], []
        others = self.other.encode([t[len(self.lead) :] for t in joined])
        for row, ids, ok, other in zip(rows, *self._learn(joined), others, strict=True):
            starts = np.flatnonzero(self.leads[ids])
            if ok and len(starts) == len(row):
                packed = np.array(ids, np.int32).tobytes()
                self.ids.update((w, packed[4 * a : 4 * b]) for w, a, b in zip(row, starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True))
                doubtful += row if ids != other else []
            else:
                alone += row
        ids, same = self._learn(alone)
        self.ids.update((w, np.array(x, np.int32).tobytes()) for w, x in zip(alone, ids, strict=True))
        self.lossy.update(w for w, ok in zip(alone, same, strict=True) if not ok)
        # Rows that agree are settled; words of others are compared singly, and those without the lead with their text.
        doubtful += alone
        led = [w for w in doubtful if w.startswith(self.lead) and SPACE not in w]
        self.odd.update(set(doubtful).difference(led))
        self.odd.update(w for w, x in zip(led, self.other.encode([w[len(self.lead) :] for w in led]), strict=True) if np.array(x, np.int32).tobytes() != self.ids[w])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bool], list[bool]]:
        """Flat ids, the texts' offsets in them, round trips, and whether the sentencepiece library gives the same ids."""
        if not self.by_word:
            ids, same = self._learn(texts)
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            return flat, np.cumsum([0, *map(len, ids)]), same, [x == y for x, y in zip(ids, self.other.encode(texts), strict=True)]
        words = [WORD.findall(self.lead + t) if t else [] for t in texts]
        if len(self.ids) > self.remembered:
            self.ids, self.lossy, self.odd = {}, set(), set()
        self._remember(list(set(chain.from_iterable(words)).difference(self.ids)))
        parts = [b"".join(map(self.ids.__getitem__, w)) for w in words]
        same = [self.lossy.isdisjoint(w) for w in words] if self.lossy else [True] * len(words)
        alike = [self.odd.isdisjoint(w) or p == np.array(self.other.encode(t), np.int32).tobytes() for w, p, t in zip(words, parts, texts, strict=True)]
        return np.frombuffer(b"".join(parts), np.int32), np.cumsum([0, *(len(p) // 4 for p in parts)]), same, alike


class Decoder:
    """Texts of ids; what an id stands for is asked from the library once, texts with byte pieces are given to it whole."""

    def __init__(self, model: bytes) -> None:
        proto = _proto(model)
        self.library = build(model)
        single = build(model, prefix=False).decode_batch([[i] for i in range(len(proto.pieces))], skip_special_tokens=False)
        self.texts = np.array(single, object)
        self.octets = np.array([p.type == BYTE for p in proto.pieces])
        self.lead = " " if proto.normalizer_spec.add_dummy_prefix else ""

    def decode(self, flat: np.ndarray, at: np.ndarray) -> list[str]:
        """Texts of the ids between offsets; ids that the model doesn't have stand for nothing."""
        known = (flat >= 0) & (flat < len(self.texts))
        flat, at = flat[known], np.concatenate(([0], np.cumsum(known)))[at]
        octets = np.concatenate(([0], np.cumsum(self.octets[flat])))
        out = ["".join(self.texts[flat[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)]
        out = [t.removeprefix(self.lead) for t in out]
        mixed = [i for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if octets[b] > octets[a]]
        for i, text in zip(mixed, self.library.decode_batch([flat[at[i] : at[i + 1]].tolist() for i in mixed], skip_special_tokens=False), strict=True):
            out[i] = text
        return out


def differing(model: bytes, texts: list[str]) -> list[str]:
    """Texts whose ids differ from those of the sentencepiece library, by either way of encoding."""
    other = sentencepiece.SentencePieceProcessor(model_proto=model).encode(texts)
    whole = [e.ids for e in build(model).encode_batch(texts, add_special_tokens=False)]
    flat, at, _, _ = Codec(model).encode(texts)
    parts = [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    return [t for t, x, y, z in zip(texts, other, whole, parts, strict=True) if not x == y == z]


@lru_cache(maxsize=2)
def _worker(kind: type, model: bytes, threads: int) -> Codec | Decoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    return kind(model)


def encode(docs: DataFrame, model_path: str, *, threads: int = 2, batch_bytes: int = 1 << 20) -> DataFrame:
    """All columns of ``docs`` (with text) that don't clash, and ids, n_tokens, round_trip, parity.

    ``ids`` are the token ids of the whole text, without special tokens; ``round_trip`` tells
    whether they decode to exactly the text (a text with the space marker itself, U+2581, does
    not), ``parity`` whether the sentencepiece library gives the same ids. A null text counts as empty: no
    ids, and it round-trips. Every row gives one row; an empty table gives none. Columns already named ids,
    n_tokens, round_trip or parity are replaced.

    The driver reads the model, checks that its rebuilt form agrees with the sentencepiece library on
    fixed probes, and sends it to the tasks; a task encodes slices of about ``batch_bytes``
    with ``threads`` threads. There is no shuffle.
    """
    with open(model_path, "rb") as file:
        model = file.read()
    if wrong := differing(model, list(PROBES)):
        raise ValueError(f"the rebuilt model differs from the original on {wrong[:3]!r}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("ids", "n_tokens", "round_trip", "parity")]
    flags = [T.StructField(c, T.BooleanType()) for c in ("round_trip", "parity")]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("n_tokens", T.LongType()), *flags])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(Codec, shared.value, threads)
        for part in slices(batches, "text", batch_bytes):
            texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
            flat, at, same, alike = codec.encode(texts)
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat))
            columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
            extra = [ids, pa.array(np.diff(at).astype(np.int64)), pa.array(same, pa.bool_()), pa.array(alike, pa.bool_())]
            yield pa.record_batch([*columns, *extra], [f.name for f in schema.fields])

    return docs.select(*dict.fromkeys([f.name for f in kept])).mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str, *, ids: str = "ids", out: str = "decoded", threads: int = 2) -> DataFrame:
    """All columns of ``rows`` and the text that the token ids in ``ids`` stand for, in ``out`` (replaced if there).

    A null list gives a null text, an empty one an empty text; null ids and ids that the model doesn't have stand for
    nothing; bytes that are no UTF-8 become U+FFFD. Every row gives one row, an empty table none. No shuffle.
    """
    with open(model_path, "rb") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())
    kept = [f for f in rows.schema.fields if f.name.lower() != out.lower()]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _worker(Decoder, shared.value, threads)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))))
            texts = pa.array(codec.decode(flat, at), pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.record_batch([*batch.columns[:-1], texts], schema.names)

    columns = [F.col(f"`{f.name}`") for f in kept]
    return rows.select(*columns, F.col(f"`{ids}`").cast("array<int>").alias("_ids")).mapInArrow(run, schema)
