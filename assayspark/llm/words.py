"""Words of text batches as numpy arrays: the small per-batch helper that several operators share.

A word is a maximal run of bytes outside space and \\t \\n \\v \\f \\r. It is known by a 64-bit fingerprint: a
polynomial of random byte values, computed for all words of a batch at once from running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
SPACES = b" \t\n\x0b\x0c\r"
_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64
_PIECE = 1 << 18


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: well spread, one to one for a given salt."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & MASK)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(256, dtype=np.uint64), 77)
    if lower:
        values[65:91] = values[97:123]
    return values


_TABLES: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, as many as asked for."""
    if len(_TABLES.get("up", ())) < n:
        n = max(n, _PIECE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.ones(n, np.uint64)
            p[1:] = np.uint64(base)
            _TABLES[name] = np.multiply.accumulate(p)
    return _TABLES["up"], _TABLES["down"]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the n + 1 offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes of text (one row at least), so that what is held at once stays bounded."""
    _, offs = bytes_of(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield at, end
        at = end


class Words:
    """The words of a text column.

    hash: a fingerprint per word; owner: its text; starts: the n + 1 word offsets of the texts; first, last: byte ranges.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = bytes_of(column)
        self.texts = len(column)
        space = np.zeros(256, bool)
        space[list(SPACES)] = True
        inside = ~space[self.data]
        n = len(inside)
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
            begins[cuts] = inside[cuts]
            ends[cuts - 1] = inside[cuts - 1]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.starts = np.searchsorted(self.first, self.offsets).astype(np.int64)
        self.owner = np.repeat(np.arange(self.texts), np.diff(self.starts))
        self.hash = self._fingerprints(_byte_values(lower))

    def _fingerprints(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.first), np.uint64)
        at = 0
        while at < len(out):
            origin = self.first[at]
            end = max(at + 1, int(np.searchsorted(self.last, origin + _PIECE, "right")))
            span = self.last[end - 1] - origin
            up, down = _powers(int(span))
            with np.errstate(over="ignore"):
                run = np.zeros(span + 1, np.uint64)
                np.cumsum(values[self.data[origin : origin + span]] * up[:span], out=run[1:])
                first, last = self.first[at:end] - origin, self.last[at:end] - origin
                out[at:end] = (run[last] - run[first]) * down[first]
            at = end
        return mix(out)

    def __len__(self) -> int:
        return self.texts

    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    def left(self) -> np.ndarray:
        """For each word, how many words its text has from there to its end."""
        return np.repeat(self.starts[1:], self.lengths()) - np.arange(len(self.hash))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for the window of `size` items that begins at each item; the last size - 1 are not whole windows."""
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(size, n)):
            total[: n - k] = total[: n - k] * np.uint64(0x100000001B3) + mix(hashes[k:], k)
    return mix(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words and the text of each; a shorter text with words is one window."""
    total, lengths = windows(words.hash, size), words.lengths()
    whole = words.left() >= size
    with np.errstate(over="ignore"):
        for t in np.flatnonzero((lengths > 0) & (lengths < size)):
            s, e = words.starts[t], words.starts[t + 1]
            acc = np.uint64(e - s)
            for h in words.hash[s:e]:
                acc = acc * np.uint64(0x9E3779B97F4A7C15) + h
            total[s] = mix(np.array([acc], np.uint64), 9)[0]
            whole[s] = True
    return total[whole], words.owner[whole]


def text_sums(values: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Sum of the values of each text."""
    return np.bincount(owner, values, texts) if len(values) else np.zeros(texts)
