"""Whole-number arrays as compact bytes, for tables that hold many of them a row."""

from __future__ import annotations

import struct
from functools import cache

import numpy as np
import zstandard


@cache
def _codecs() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative numbers; each takes as many byte planes as its largest number needs."""
    head, planes = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        width = (int(a.max(initial=0)).bit_length() + 7) // 8
        head.append(struct.pack("<QB", len(a), width))
        planes.append(a.view(np.uint8).reshape(-1, 8).T[:width].tobytes())
    return b"".join(head) + _codecs()[0].compress(b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays of a packed value, as unsigned 64-bit numbers."""
    n, at, shapes = blob[0], 1, []
    for _ in range(n):
        shapes.append(struct.unpack_from("<QB", blob, at))
        at += 9
    raw, out, at = np.frombuffer(_codecs()[1].decompress(blob[at:]), np.uint8), [], 0
    for length, width in shapes:
        a = np.zeros((length, 8), np.uint8)
        a[:, :width] = raw[at : at + length * width].reshape(width, length).T
        out.append(a.view("<u8").ravel())
        at += length * width
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, which take fewer byte planes; ``np.cumsum`` undoes them."""
    return np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))
