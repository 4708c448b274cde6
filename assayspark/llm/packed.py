"""Arrays packed into rows, for exchanges of many small numbers between blocks of text and buckets."""

from __future__ import annotations

import struct

import numpy as np
import zstandard


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, each byte of the numbers apart."""
    out = [struct.pack("<H", len(arrays))]
    for a in arrays:
        a = np.ascontiguousarray(a)
        body = zstandard.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), 3) if len(a) else b""
        out.append(struct.pack("<2sQQ", a.dtype.str[1:].encode(), len(a), len(body)) + body)
    return b"".join(out)


def unpack(data: bytes) -> list[np.ndarray]:
    (n,), at, out = struct.unpack_from("<H", data), 2, []
    for _ in range(n):
        kind, length, size = struct.unpack_from("<2sQQ", data, at)
        at += 18
        dtype = np.dtype("<" + kind.decode())
        if length:
            raw = zstandard.decompress(data[at : at + size], max_output_size=length * dtype.itemsize)
            out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, length).T).view(dtype).ravel())
        else:
            out.append(np.zeros(0, dtype))
        at += size
    return out
