"""A signature tree over sets, and its self-join by dual traversal.

Leaves are sets; a node holds the OR of its sets' token bitmaps, the least and greatest
size below it, and the greatest number of tokens that any of its sets loses to shared
bits. A token that two sets share has its bit in both bitmaps, so no pair below two nodes
can share more tokens than the nodes have common bits, plus the tokens that one of the
sets may hide behind a shared bit. Pairs of nodes whose bound is too low for their sizes
are left, and so are those whose sets are all known to be linked to each other already:
the join returns links enough to connect what is linked, not all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

LEAF = 4
FANOUT = 4


def linked(common: int, a: int, b: int) -> bool:
    """Similarity of at least 0.8 for sets of ``a`` and ``b`` with ``common`` tokens in both."""
    return 100 * common >= 80 * (a + b - common)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


@dataclass
class Node:
    members: np.ndarray
    bits: np.ndarray
    least: int
    most: int
    hidden: int
    below: list["Node"]
    one: bool = False  # all members are linked already


class SignatureTree:
    """Tree over sorted, distinct, non-empty sets of 64-bit tokens."""

    def __init__(self, sets: Sequence[np.ndarray], classes: Sequence[int] | None = None):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        width = 64
        while width < 4 * int(self.sizes.max(initial=1)) and width < 1 << 17:
            width *= 2
        self.signatures = np.zeros((len(sets), width // 8), np.uint8)
        for i, s in enumerate(sets):
            flags = np.zeros(width, np.uint8)
            flags[(s & np.uint64(width - 1)).astype(np.int64)] = 1
            self.signatures[i] = np.packbits(flags)
        self.hidden = self.sizes - np.bitwise_count(self.signatures).sum(axis=1)
        self.up = list(range(len(sets)))
        if classes is not None:
            seen: dict[int, int] = {}
            for i, c in enumerate(classes):
                self.up[i] = seen.setdefault(c, i)
        # Sets of like size and with the same least token are neighbours, so that nodes stay sparse.
        band = np.floor(np.log(np.maximum(self.sizes, 1)) / np.log(1.25))
        least = np.array([s[0] for s in sets], np.uint64)
        self.root = self._node(np.lexsort((least, band))) if len(sets) else None

    def _node(self, members: np.ndarray) -> Node:
        below = []
        if len(members) > LEAF:
            below = [self._node(part) for part in np.array_split(members, FANOUT)]
        sizes = self.sizes[members]
        return Node(
            members, np.bitwise_or.reduce(self.signatures[members], axis=0),
            int(sizes.min()), int(sizes.max()), int(self.hidden[members].max()), below,
        )

    def _find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def _one(self, node: Node) -> bool:
        if not node.one:
            first = self._find(int(node.members[0]))
            node.one = all(self._find(int(m)) == first for m in node.members)
        return node.one

    def _may_link(self, a: Node, b: Node) -> bool:
        if 5 * a.most < 4 * b.least or 5 * b.most < 4 * a.least:
            return False
        overlap = int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.hidden, b.hidden)
        return linked(min(overlap, a.most, b.most), max(a.least, 1), max(b.least, 1)) if overlap else False

    def links(self, across: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Pairs that link, enough to connect all sets that links connect.

        With ``across``, a side per set, only pairs of different sides are looked at.
        """
        out: list[tuple[int, int]] = []
        todo = [(self.root, self.root)] if self.root else []
        while todo:
            a, b = todo.pop()
            if a is b:
                if self._one(a):
                    continue
                if a.below:
                    # Own pairs first: they connect sets and spare pairs across.
                    for i, x in enumerate(a.below):
                        todo += [(x, y) for y in a.below[i + 1 :]]
                    todo += [(x, x) for x in a.below]
                    continue
            elif self._one(a) and self._one(b) and self._find(int(a.members[0])) == self._find(int(b.members[0])):
                continue
            elif not self._may_link(a, b):
                continue
            elif a.below or b.below:
                if b.below and (not a.below or len(b.members) > len(a.members)):
                    a, b = b, a
                todo += [(x, b) for x in a.below]
                continue
            for p, i in enumerate(a.members.tolist()):
                for j in (a.members[p + 1 :] if a is b else b.members).tolist():
                    if across is not None and across[i] == across[j]:
                        continue
                    x, y = self._find(i), self._find(j)
                    if x != y and linked(self._bound(i, j), int(self.sizes[i]), int(self.sizes[j])):
                        if linked(common(self.sets[i], self.sets[j]), len(self.sets[i]), len(self.sets[j])):
                            self.up[max(x, y)] = min(x, y)
                            out.append((i, j))
        return out

    def _bound(self, i: int, j: int) -> int:
        shared = int(np.bitwise_count(self.signatures[i] & self.signatures[j]).sum())
        return min(shared + min(self.hidden[i], self.hidden[j]), self.sizes[i], self.sizes[j])
