"""Greedy word-piece counts by a linear longest-match automaton.

A text is cut into words and runs of white space; a word takes the one space right before
it along, other white space stands for itself, so that every byte is counted. The bytes of
each are matched greedily, longest piece first, against the byte-level vocabulary. The automaton is the vocabulary's trie with a failure link per node and
the number of pieces that following the link pops. A word is read once, byte by byte;
counts are added up and no piece is ever built.

The vocabulary holds every byte, so any text can be matched. The file is read where the
query is built and travels with the task. Null and empty texts count 0; texts of white
space have tokens but no words. Repeated rows
count each for itself; other columns do not matter.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchvault.llm.common import TEXT, chunks, record

MEMO = 200_000  # words whose counts a task remembers at a time


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> dict[bytes, int]:
    """Pieces of a byte-level vocabulary file as bytes, without special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", ())}
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}


class Automaton:
    """Trie with failure links. ``children[node]`` maps a byte to a node; node 0 is the root."""

    def __init__(self, pieces: list[bytes]):
        self.children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for b in piece:
                down = self.children[node].get(b)
                if down is None:
                    down = self.children[node][b] = len(self.children)
                    self.children.append({})
                    final.append(False)
                node = down
            final[node] = True
        # fail: where to go on when no child fits; popped: pieces that this finishes.
        # -1: the bytes read cannot be cut into pieces (not with all bytes in the vocabulary).
        self.fail = [-1] * len(final)
        self.popped = [0] * len(final)
        level = [0]
        while level:
            below = []
            for parent in level:
                for b, node in self.children[parent].items():
                    below.append(node)
                    if final[node]:
                        self.fail[node], self.popped[node] = 0, 1
                        continue
                    at, count = self.fail[parent], self.popped[parent]
                    while at != -1 and b not in self.children[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at != -1:
                        self.fail[node], self.popped[node] = self.children[at][b], count
            level = below

    def count(self, word: bytes) -> int:
        """Number of greedy longest-match pieces of ``word``; -1 if it cannot be cut."""
        children, fail, popped = self.children, self.fail, self.popped
        node = total = 0
        for b in word:
            down = children[node].get(b)
            while down is None:
                total += popped[node]
                node = fail[node]
                if node == -1:
                    return -1
                down = children[node].get(b)
            node = down
        while node:
            total += popped[node]
            node = fail[node]
            if node == -1:
                return -1
        return total


@lru_cache(maxsize=2)
def _automaton(pieces: tuple[bytes, ...]) -> Automaton:
    return Automaton(list(pieces))


class _Counts(dict):
    """Counts of words, worked out when first met; emptied when it has grown too large."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        out = self[word] = self.automaton.count(word)
        return out


# White space is tab, line feed to carriage return, and space.
_UNIT = re.compile(rb" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]")


def units(text: bytes) -> list[bytes]:
    """Words, each with one space right before it, and the white space between; together the text."""
    return _UNIT.findall(text)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """Per document: n_words, n_tokens of the whole text, and the most pieces that a word has."""
    pieces = tuple(sorted(vocabulary(path)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("max_word_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Counts(_automaton(pieces))
        for batch in batches:
            for first, raw, offsets in chunks(batch):
                text = raw.tobytes()
                rows = []
                for i in range(len(offsets) - 1):
                    each = units(text[offsets[i] : offsets[i + 1]])
                    counts = np.fromiter(map(memo.__getitem__, each), np.int64, len(each))
                    # A word ends in something else than white space.
                    of_words = counts[np.fromiter((not 9 <= u[-1] <= 13 and u[-1] != 32 for u in each), bool, len(each))]
                    rows.append((len(of_words), int(counts.sum()), int(of_words.max(initial=0))))
                ids = batch.column("doc_id").slice(first, len(rows))
                yield record(schema, ids, *map(list, zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long"), F.expr(TEXT)).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, max_word_tokens long")
