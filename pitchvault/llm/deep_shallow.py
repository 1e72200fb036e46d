"""Deep-shallow sorting of byte strings of equal width.

Shallow: multikey sorting by machine words. Strings are ordered by one word at a time; those
with another word are done, runs with the same word go on to the next, down to the shallow
depth. Deep: what is left are runs with a long common prefix, and each is ordered by a blind
trie, which stores only the places where its strings branch. A string goes down the trie
looking at those bytes alone, is compared once with the leaf it ends at, and is hung in
where the two part.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

SHALLOW = 4  # words


def common_prefix(a: bytes, b: bytes) -> int:
    """Number of leading bytes that two strings of equal length share."""
    low, high = 0, len(a)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class BlindTrie:
    """Strings of equal length. An inner node is [depth, {byte: child}], a leaf the string itself."""

    def __init__(self, strings: Iterable[bytes]):
        self.root: list | bytes | None = None
        for s in strings:
            self.add(s)

    def add(self, s: bytes) -> None:
        if self.root is None:
            self.root = s
            return
        at = self.root
        while not isinstance(at, bytes):
            depth, below = at
            at = below.get(s[depth]) or next(iter(below.values()))
        split = common_prefix(s, at)
        if split == len(s):
            return
        up, at = None, self.root
        while not isinstance(at, bytes) and at[0] < split:
            up, at = at, at[1][s[at[0]]]
        if not isinstance(at, bytes) and at[0] == split:
            at[1][s[split]] = s
            return
        other = at
        while not isinstance(other, bytes):
            other = next(iter(other[1].values()))
        node = [split, {s[split]: s, other[split]: at}]
        if up is None:
            self.root = node
        else:
            up[1][s[up[0]]] = node

    def sorted(self) -> list[bytes]:
        out, todo = [], [self.root] if self.root is not None else []
        while todo:
            at = todo.pop()
            if isinstance(at, bytes):
                out.append(at)
            else:
                todo += [at[1][b] for b in sorted(at[1], reverse=True)]
        return out


def deep_shallow(strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp) of the rows of a byte matrix; ``lcp[i]`` is between the rows ordered i and i + 1."""
    n, width = strings.shape
    if n < 2:
        return np.arange(n), np.empty(0, np.int64)
    words = -(-width // 8)
    padded = np.zeros((n, 8 * words), np.uint8)
    padded[:, :width] = strings
    keys = padded.view(">u8").astype(np.uint64)
    order = np.arange(n)
    run = np.zeros(n, np.int64)  # by place in the order; rows of a run have equal words so far
    for word in range(min(shallow, words)):
        open_runs = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(open_runs):
            break
        rows = order[open_runs]
        order[open_runs] = rows[np.lexsort((keys[rows, word], run[open_runs]))]
        value = keys[order, word]
        run = np.concatenate([[0], np.cumsum((run[1:] != run[:-1]) | (value[1:] != value[:-1]))])
    if words > shallow:
        ends = np.concatenate([np.flatnonzero(np.diff(run)) + 1, [n]])
        begin = 0
        for end in ends.tolist():
            if end - begin > 1:
                rows = order[begin:end]
                tails: dict[bytes, list[int]] = {}
                for row in rows.tolist():
                    tails.setdefault(strings[row, 8 * shallow :].tobytes(), []).append(row)
                if len(tails) > 1:
                    order[begin:end] = [r for t in BlindTrie(tails).sorted() for r in tails[t]]
                else:
                    order[begin:end] = rows
            begin = end
    same = strings[order[1:]] == strings[order[:-1]]
    lcp = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, lcp
