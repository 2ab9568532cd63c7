"""Word-piece counts of texts by a linear longest-match automaton.

Words are runs of other than ASCII white space; each is matched with a space in
front, taking the longest vocabulary piece again and again (greedy word-piece
segmentation over bytes). The automaton gives the number of pieces without
building any: it walks the vocabulary trie, and where a byte has no child it
follows the node's failure link, which leads to the node of what is left
after popping the longest matching pieces from the node's string, and adds the
precomputed number of popped pieces. Each byte is read once; links are followed
at most once per byte.

The vocabulary is a public rank file, named by a parameter, that every executor
can read; it holds all single bytes, so every text has a count. Counts of
short words are kept in a bounded memo per Python worker.

Null and empty texts have no words and no tokens. Rows with null or repeated
ids stay as they are; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, resident, utf8
from tallyspark.llm.vocabulary import Trie, load_trie

MEMO_ENTRIES = 400_000
MEMO_WORD = 32

RESULT_SCHEMA = "doc_id long, n_words long, n_tokens long"


class LongestMatch:
    """Failure links and popped-piece counts of a vocabulary trie."""

    def __init__(self, trie: Trie) -> None:
        n = len(trie.parent)
        parent, byte = trie.parent.tolist(), trie.byte.tolist()
        edges: list[dict[int, int]] = [{} for _ in range(n)]
        for node in range(1, n):
            edges[parent[node]][byte[node]] = node
        fail, popped = [0] * n, [0] * n
        for node, piece in enumerate(trie.piece.tolist()):  # shorter strings come first
            if piece >= 0:
                popped[node] = 1  # the whole string is one piece; nothing is left
            elif node:
                count, at = popped[parent[node]], fail[parent[node]]
                while byte[node] not in edges[at]:
                    count += popped[at]
                    at = fail[at]
                fail[node], popped[node] = edges[at][byte[node]], count
        self.edges, self.fail, self.popped = edges, fail, popped
        self.after_space = edges[0][0x20]
        self.memo: dict[bytes, int] = {}

    def word(self, word: bytes) -> int:
        """Pieces of a word with a space in front."""
        edges, fail, popped = self.edges, self.fail, self.popped
        count, node = 0, self.after_space
        for byte in word:
            while (below := edges[node].get(byte)) is None:
                count += popped[node]
                node = fail[node]
            node = below
        while node:
            count += popped[node]
            node = fail[node]
        return count

    def text(self, text: bytes) -> tuple[int, int]:
        """(words, tokens) of a UTF-8 text."""
        words = text.split()
        memo = self.memo
        counts = list(map(memo.get, words))
        if None in counts:
            if len(memo) >= MEMO_ENTRIES:
                memo.clear()
            for i, known in enumerate(counts):
                if known is None:
                    counts[i] = self.word(words[i])
                    if len(words[i]) <= MEMO_WORD:
                        memo[words[i]] = counts[i]
        return len(words), sum(counts)


def automaton(ranks: str) -> LongestMatch:
    """One per Python worker, whatever the number of its tasks."""
    return resident(("longest match", ranks), lambda: LongestMatch(load_trie(ranks)))


def count_tokens(docs: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = automaton(ranks)
        for batch in batches:
            found = np.array([counter.text(x) for x in utf8(batch, "text")], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())],
                ["doc_id", "n_words", "n_tokens"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
            .transform(map_arrow, run, RESULT_SCHEMA))
