"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a byte trie. For the node of a string s that the input cannot
extend, the longest-match rule first cuts known pieces off the front of s; what is
left is again a node. That node (failure link) and the number of pieces cut off
(popped count) are computed once, breadth first, so a word is counted in one pass over
its bytes without building a piece.

A word is matched with a space in front: pieces that start words begin with a space,
the others continue words. A word that cannot be cut into pieces counts as one.

The driver compiles the automaton (as large as the vocabulary, whatever the corpus is)
and ships it as a file; tasks count whole texts and remember the counts of at most
``MEMO`` words.

Defined results: a null or empty text has no words and no tokens; repeated rows stay;
an empty table gives an empty result; no other column of the input is read.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from workwindow.llm.common import mapped_bytes, parts_of, shared_bytes

MEMO = 500_000
NONE = -1


class Automaton:
    """Transitions (node * 256 + byte to node), failure links and popped counts."""

    def __init__(self, step: dict[int, int], link: list[int], popped: list[int]):
        self.step, self.link, self.popped = step, link, popped

    @classmethod
    def compile(cls, pieces: Iterable[bytes]) -> Automaton:
        step: dict[int, int] = {}
        is_piece = [False]
        children: list[list[tuple[int, int]]] = [[]]
        for piece in pieces:
            node = 0
            for byte in piece:
                following = step.get(node << 8 | byte)
                if following is None:
                    following = step[node << 8 | byte] = len(is_piece)
                    is_piece.append(False)
                    children.append([])
                    children[node].append((byte, following))
                node = following
            is_piece[node] = node != 0
        link, popped = [NONE] * len(is_piece), [0] * len(is_piece)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in children[parent]:
                queue.append(node)
                if is_piece[node]:
                    link[node], popped[node] = 0, 1
                    continue
                at, cut = link[parent], popped[parent]
                while at != NONE and (following := step.get(at << 8 | byte)) is None:
                    cut += popped[at]
                    at = link[at]
                if at != NONE:
                    link[node], popped[node] = following, cut
        return cls(step, link, popped)

    def count(self, word: bytes) -> int:
        """Pieces of a word, 1 if it has no division into pieces."""
        step, link, popped = self.step, self.link, self.popped
        node = pieces = 0
        for byte in b" " + word:
            while (following := step.get(node << 8 | byte)) is None:
                pieces += popped[node]
                node = link[node]
                if node == NONE:
                    return 1
            node = following
        while node:
            pieces += popped[node]
            node = link[node]
            if node == NONE:
                return 1
        return pieces

    def dump(self) -> bytes:
        keys = np.fromiter(self.step.keys(), np.int64, len(self.step))
        values = np.fromiter(self.step.values(), np.int32, len(self.step))
        nodes = np.array([len(keys), len(self.link)], np.int64)
        rest = np.array([self.link, self.popped], np.int32)
        return nodes.tobytes() + keys.tobytes() + values.tobytes() + rest.tobytes()

    @classmethod
    def load(cls, data: bytes) -> Automaton:
        n_steps, n_nodes = np.frombuffer(data, np.int64, 2).tolist()
        keys = np.frombuffer(data, np.int64, n_steps, 16)
        values = np.frombuffer(data, np.int32, n_steps, 16 + 8 * n_steps)
        rest = np.frombuffer(data, np.int32, 2 * n_nodes, 16 + 12 * n_steps).reshape(2, -1)
        return cls(dict(zip(keys.tolist(), values.tolist())), rest[0].tolist(), rest[1].tolist())


class _Counts(dict):
    """Piece counts of words, filled when asked, emptied when full."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        self[word] = found = self.automaton.count(word)
        return found


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a vocabulary file with one base64 piece and its rank a line."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


_loaded: dict[str, _Counts] = {}


def token_counts(documents: DataFrame, pieces: Iterable[bytes]) -> DataFrame:
    """doc_id, n_words, n_tokens of every row of ``documents`` (doc_id, text)."""
    name = shared_bytes(documents.sparkSession, "pieces", Automaton.compile(pieces).dump())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _loaded:
            _loaded.clear()
            _loaded[name] = _Counts(Automaton.load(mapped_bytes(name)))
        of = _loaded[name].__getitem__
        for part in parts_of(batches, "text"):
            words = [(t or "").encode().split() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([sum(map(of, w)) for w in words], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_words bigint, n_tokens bigint"
    )
