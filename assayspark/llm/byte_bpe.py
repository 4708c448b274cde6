"""Byte-level BPE through a sentencepiece model written straight from the ranks.

Every byte b becomes the character 256 + b, so any token is a piece of plain letters. Pieces score minus their rank,
so sentencepiece merges the pair of lowest rank first, leftmost among equals. Normalisation is the identity. A
pre-token (one match of the pattern) that is itself in the vocabulary is its own token, as in the rank-file libraries.
Decoding maps each id back to its bytes.

Null text encodes like empty text, to no ids. Special tokens are ordinary text. Repeated rows encode alike, an empty
table gives an empty result, and other columns pass through untouched.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from assayspark.llm.common import Shared
from assayspark.llm.words import slices

CACHED = 100_000  # pre-tokens that a task remembers before it starts anew: a bound on memory, not on results


@dataclass(frozen=True)
class Vocabulary:
    """What tasks need: the pattern, the tokens in the order of their ids, and the serialised model."""

    pattern: str
    tokens: list[bytes]
    model: bytes


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: bytes | int | float) -> bytes:
    """One field of a protocol buffer message."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def letters(data: bytes) -> str:
    """Bytes as characters 256 to 511."""
    return (np.frombuffer(data, np.uint8).astype("<u2") + 256).tobytes().decode("utf-16-le")


def serialise(tokens: list[bytes]) -> bytes:
    """The model file: one piece a token, then the unknown piece that the format asks for and no text can reach."""
    # Fixed values of the format: 1 pieces, 2 trainer, 3 normaliser; model type 2 is BPE; piece type 2 is unknown.
    pieces = [_field(1, letters(t).encode()) + _field(2, float(-rank)) for rank, t in enumerate(tokens)]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


def load(rank_file: str, pattern: str) -> Vocabulary:
    """Read a rank file (base64 token and rank a line, ranks from 0 without gaps) on the driver."""
    with open(rank_file, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}
    tokens = [ranks[i] for i in range(len(ranks))]
    return Vocabulary(pattern, tokens, serialise(tokens))


def spread(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of one item after the other, and where each item ends."""
    size = sizes[items]
    ends = np.cumsum(size)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[items] - ends + size, size)
    return values[at], ends


class Coder:
    """Encodes and decodes inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        self.split = regex.compile(vocabulary.pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self.whole = {t: i for i, t in enumerate(vocabulary.tokens)}
        self.lengths = np.array([len(t) for t in vocabulary.tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.joined = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # pre-token -> its number
        self.counts = np.zeros(0, np.int64)  # by number: how many ids
        self.ids = np.zeros(0, np.int32)  # all ids, by number

    def _learn(self, new: list[str]) -> None:
        """Encode pre-tokens that are new, in one call; a space, which no piece holds, keeps them apart."""
        raw = [t.encode() for t in new]
        letters = np.frombuffer(b"\x00".join(raw), np.uint8).astype("<u2") + 256
        letters[np.cumsum([len(t) + 1 for t in raw])[:-1] - 1] = 32
        pieces = letters.tobytes().decode("utf-16-le").split(" ")
        apart = [k for k, t in enumerate(raw) if t not in self.whole]
        made = [[self.whole.get(t)] for t in raw]
        for k, ids in zip(apart, self.model.encode([pieces[k] for k in apart], out_type=int, num_threads=1)):
            made[k] = ids
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.counts = np.append(self.counts, np.fromiter(map(len, made), np.int64, len(made)))
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(made), np.int32))

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """The ids of each text."""
        found = [self.split(t or "") for t in texts]
        new = set(chain.from_iterable(found)).difference(self.known)
        if len(self.known) + len(new) > CACHED:
            self._forget()
            new = set(chain.from_iterable(found))
        if new:
            self._learn(list(new))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        number = np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int64, int(sizes.sum()))
        values, ends = spread(self.ids, np.cumsum(self.counts) - self.counts, self.counts, number)
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    def decode(self, column: pa.ListArray) -> pa.Array:
        """The bytes of each list of ids; null lists decode to null."""
        ids = column.flatten().to_numpy(zero_copy_only=False)
        counts = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
        data, ends = spread(self.joined, self.begins, self.lengths, ids)
        cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        valid = column.is_valid().to_pylist()
        return pa.array([data[a:b].tobytes() if ok else None for a, b, ok in zip(cuts[:-1], cuts[1:], valid)], pa.binary())


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", into: str = "ids") -> DataFrame:
    """Add the ids of each row's whole text as an array of int."""
    shared = Shared(docs.sparkSession, vocabulary)

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(shared.value)
        for column in batches:
            parts = [coder.encode(column[s:e].to_pylist()) for s, e in slices(column, 1 << 20)]
            yield pa.concat_arrays(parts or [coder.encode([])])

    return docs.withColumn(into, ids(F.col(text)))


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the bytes that each row's ids stand for."""
    shared = Shared(rows.sparkSession, vocabulary)

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Coder(shared.value)
        for column in batches:
            # rows of about a million ids at a time: what is held at once stays bounded
            counts = np.cumsum([0 if x is None else x for x in column.value_lengths().to_pylist()])
            cuts = [0, *np.flatnonzero(np.diff(counts // (1 << 20), prepend=0)).tolist(), len(column)]
            parts = [coder.decode(column[s:e]) for s, e in zip(cuts[:-1], cuts[1:]) if e > s]
            yield pa.concat_arrays(parts or [coder.decode(column)])

    return rows.withColumn(into, text(F.col(ids)))
