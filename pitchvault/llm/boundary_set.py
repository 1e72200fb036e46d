"""A compressed sorted set of numbers with rank and select.

Numbers are split by their upper bits into containers of 65,536. A container keeps its
lower 16 bits in the smallest of three forms: a sorted array, a bitmap, or runs. The
cumulative cardinalities of the containers lead a select to its container by binary
search; inside it, the form's own select finishes.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 16
BITMAP_BYTES = SPAN // 8


class Array:
    """Sorted lower halves, two bytes each."""

    def __init__(self, lows: np.ndarray):
        self.lows = lows.astype(np.uint16)

    @property
    def nbytes(self) -> int:
        return self.lows.nbytes

    def select(self, k: int) -> int:
        return int(self.lows[k])

    def rank(self, low: int) -> int:
        return int(np.searchsorted(self.lows, low))

    def values(self) -> np.ndarray:
        return self.lows.astype(np.int64)


class Bitmap:
    """One bit per number, and the cardinality up to the end of every 64-bit word."""

    def __init__(self, lows: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[lows] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int32)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes

    def _word(self, w: int) -> np.ndarray:
        return np.unpackbits(self.words[w : w + 1].view(np.uint8), bitorder="little")

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.upto, k, "right"))
        before = int(self.upto[w - 1]) if w else 0
        return 64 * w + int(np.flatnonzero(self._word(w))[k - before])

    def rank(self, low: int) -> int:
        w, bit = divmod(low, 64)
        return (int(self.upto[w - 1]) if w else 0) + int(self._word(w)[:bit].sum())

    def values(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class Runs:
    """First number and length of every run of consecutive numbers."""

    def __init__(self, lows: np.ndarray):
        first = np.flatnonzero(np.diff(lows, prepend=-2) != 1)
        self.starts = lows[first].astype(np.uint16)
        self.upto = np.append(first[1:], len(lows)).astype(np.int32)

    @property
    def nbytes(self) -> int:
        return 2 * self.starts.nbytes

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.upto, k, "right"))
        return int(self.starts[r]) + k - (int(self.upto[r - 1]) if r else 0)

    def rank(self, low: int) -> int:
        r = int(np.searchsorted(self.starts, low, "right")) - 1
        if r < 0:
            return 0
        before = int(self.upto[r - 1]) if r else 0
        return min(before + low - int(self.starts[r]), int(self.upto[r]))

    def values(self) -> np.ndarray:
        lengths = np.diff(self.upto, prepend=0)
        offset = np.arange(self.upto[-1]) - np.repeat(self.upto - lengths, lengths)
        return np.repeat(self.starts.astype(np.int64), lengths) + offset


def container(lows: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest form of some sorted, distinct lower halves."""
    runs = int(np.count_nonzero(np.diff(lows) != 1)) + 1
    if 4 * runs < min(2 * len(lows), BITMAP_BYTES):
        return Runs(lows)
    return Array(lows) if 2 * len(lows) <= BITMAP_BYTES else Bitmap(lows)


class BoundarySet:
    """Set of the sorted, distinct, non-negative numbers ``values``."""

    def __init__(self, values: np.ndarray):
        high = values >> 16
        first = np.flatnonzero(np.diff(high, prepend=-1))
        last = np.append(first[1:], len(values)) if len(first) else first
        self.highs = high[first]
        self.upto = last  # cardinality up to the end of every container
        self.containers = [container(values[a:b] & (SPAN - 1)) for a, b in zip(first, last, strict=True)]

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    @property
    def nbytes(self) -> int:
        return sum(c.nbytes for c in self.containers)

    def select(self, k: int) -> int:
        """The number with ``k`` smaller ones in the set."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.upto, k, "right"))
        before = int(self.upto[c - 1]) if c else 0
        return (int(self.highs[c]) << 16) + self.containers[c].select(k - before)

    def rank(self, value: int) -> int:
        """How many numbers of the set are smaller than ``value``."""
        high, low = value >> 16, value & (SPAN - 1)
        c = int(np.searchsorted(self.highs, high))
        before = int(self.upto[c - 1]) if c else 0
        if c < len(self.highs) and self.highs[c] == high:
            return before + self.containers[c].rank(low)
        return before

    def values(self) -> np.ndarray:
        parts = [(int(h) << 16) + c.values() for h, c in zip(self.highs, self.containers, strict=True)]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)
