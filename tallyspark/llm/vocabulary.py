"""A fixed public vocabulary of byte pieces as a trie."""

from __future__ import annotations

import base64
from functools import cached_property

import numpy as np

from tallyspark.llm.common import resident


class Trie:
    """Nodes are numbered by the length of their string, so a parent comes
    before its children; node 0 is the root. ``piece`` is the number of the
    vocabulary entry that ends at a node, or -1. All single bytes belong to
    the vocabulary, so every text can be cut into pieces."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = sorted(set(pieces) | {bytes([b]) for b in range(256)},
                             key=lambda p: (len(p), p))
        prefixes = {p[:end] for p in self.pieces for end in range(len(p) + 1)}
        order = sorted(prefixes, key=lambda p: (len(p), p))
        number = {p: i for i, p in enumerate(order)}
        self.parent = np.array([number[p[:-1]] for p in order], np.int32)
        self.byte = np.array([p[-1] if p else 0 for p in order], np.uint8)
        self.piece = np.full(len(order), -1, np.int32)
        self.piece[[number[p] for p in self.pieces]] = np.arange(len(self.pieces))

    @cached_property
    def _children(self) -> tuple[np.ndarray, np.ndarray]:
        """Row of each node, and child by row and byte, 0 where there is none.
        Leaves share the last row."""
        inner = np.unique(self.parent[1:])
        row = np.full(len(self.parent), len(inner), np.int32)
        row[inner] = np.arange(len(inner))
        table = np.zeros((len(inner) + 1, 256), np.int32)
        table[row[self.parent[1:]], self.byte[1:]] = np.arange(1, len(self.parent))
        return row, table

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Children of nodes, 0 where there is none."""
        row, table = self._children
        return table[row[node], byte]


def load_trie(ranks: str) -> Trie:
    """The trie of a rank file (a base64 piece and its number per line)."""
    def build() -> Trie:
        with open(ranks, "rb") as file:
            return Trie([base64.b64decode(line.split()[0]) for line in file if line.strip()])

    return resident(("trie", ranks), build)
