"""Benchmark decontamination: document passages that match a benchmark item.

Windows as long as the item slide over each document. A window matches if its
SimHash is within ``radius`` bits of the item's and the weighted Jaccard
similarity of their word shingles (a shingle weighs as often as it occurs) is
at least ``similarity``.

The item side is bounded: the benchmark is cut into blocks of at most
``max_items`` items and MAX_ITEM_CHARS characters before anything is
broadcast, and each block is searched against all documents. The index of one
block holds each item's shingles and, for each of the eight bytes of a
SimHash, the items within ``radius // 8`` bits of every possible byte value:
two fingerprints within the radius are that close in at least one byte, so no
window within the radius is missed.

In one document, windows that can reach the similarity are known from running
counts of the item's shingles (a window needs ``s (n + m) / (1 + s)`` of
them); only these are fingerprinted, looked up and compared exactly. Documents
are never shuffled: the work is one pass over the rows, whatever their source
or number of copies.

Words are runs of other than ASCII white space, letters lower-cased. Texts or
items of fewer words than a shingle count as one shingle; a document shorter
than the item is one window. Nulls: null texts and items have no words and
match nothing; rows with a null ``doc_id`` or ``item_id`` are reported under
null. Repeated rows are reported as often as they occur. Extra columns are
ignored. Very long texts are searched whole, in one task each. Empty tables give
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import gram_hashes, map_arrow, utf8, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
MAX_ITEMS = 20_000
MAX_ITEM_CHARS = 4_000_000

RESULT_SCHEMA = ("doc_id long, item_id long, first_word long, n_words long, distance int, "
                 "similarity double")


def shingle_hashes(text: bytes, size: int) -> tuple[np.ndarray, int]:
    """Hashes of a text's word shingles, and its number of words."""
    words = word_hashes(text.decode().lower().encode())
    return gram_hashes(words, min(size, len(words))) if len(words) else words, len(words)


def weighted_simhash(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little")
    ones = (2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).astype(np.uint8)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum(min(n, b[x]) for x, n in a.items() if x in b)
    return both / (a.total() + b.total() - both)


class ItemIndex:
    """The bounded item side: shingles, fingerprints, and the multi-index of
    fingerprint bytes."""

    def __init__(self, items: list[tuple[int | None, str]], size: int, radius: int) -> None:
        self.size, self.radius = size, radius
        self.ids, self.shingles, self.words, prints = [], [], [], []
        self.short: dict[int, dict[int, list]] = {}  # of fewer words than a shingle
        for item_id, text in items:
            hashes, n_words = shingle_hashes(text.encode(), size)
            if 0 < n_words < size:
                self.short.setdefault(n_words, {}).setdefault(int(hashes[0]), []).append(item_id)
            elif n_words:
                self.ids.append(item_id)
                self.shingles.append(hashes)
                self.words.append(n_words)
                prints.append(weighted_simhash(hashes))
        pairs = sorted((h, i) for i, x in enumerate(self.shingles) for h in set(x.tolist()))
        self.keys = np.array([h for h, _ in pairs], np.uint64)
        self.items = np.array([i for _, i in pairs], np.int64)
        self.prints = np.array(prints, np.uint64)
        every = np.arange(256, dtype=np.uint8)
        #: near[byte][value]: a bit for each item
        self.near = [np.packbits(np.bitwise_count(every[:, None] ^ own[None, :]) <= radius // 8, axis=1)
                     for own in self.prints.view(np.uint8).reshape(-1, 8).T]

    def within(self, item: int, prints: list[int]) -> list[tuple[int, int]]:
        """(position in prints, distance) of those within the radius of the item."""
        values = np.array(prints, "<u8")
        close = np.zeros(len(values), bool)
        for table, byte in zip(self.near, values.view(np.uint8).reshape(-1, 8).T, strict=True):
            close |= (table[byte, item // 8] >> (7 - item % 8) & 1).astype(bool)
        at = np.flatnonzero(close)
        distance = np.bitwise_count(values[at] ^ self.prints[item])
        return [(int(i), int(d)) for i, d in zip(at, distance, strict=True) if d <= self.radius]

    def matches(self, text: bytes, similarity: float) -> list[tuple]:
        """Best window of each item that the text holds: (item_id, first word,
        words, distance, similarity); the earliest of equals."""
        words = word_hashes(text.decode().lower().encode())
        if not len(words):
            return []
        found = []
        for n, own in self.short.items():
            seen: dict[int, int] = {}
            for at, h in enumerate(gram_hashes(words, n).tolist()):
                if h in own:
                    seen.setdefault(h, at)
            found += [(i, at, n, 0, 1.0) for h, at in seen.items() for i in own[h]]
        hashes = gram_hashes(words, min(self.size, len(words)))
        if not len(self.keys):
            return found
        hit = np.flatnonzero(self.keys[np.minimum(np.searchsorted(self.keys, hashes),
                                                  len(self.keys) - 1)] == hashes)
        if not len(hit):
            return found
        low = np.searchsorted(self.keys, hashes[hit])
        high = np.searchsorted(self.keys, hashes[hit], "right")
        places: dict[int, list[int]] = {}
        for p, a, b in zip(hit.tolist(), low.tolist(), high.tolist(), strict=True):
            for item in self.items[a:b].tolist():
                places.setdefault(item, []).append(p)
        for item, where in places.items():
            best = self._best_window(item, hashes, np.array(where), len(words), similarity)
            if best:
                found.append((self.ids[item], *best))
        return found

    def _best_window(self, item, hashes, where, n_words, similarity):
        width = min(self.words[item], n_words)
        shingles = max(width - self.size + 1, 1)
        need = similarity * (shingles + len(self.shingles[item])) / (1 + similarity) - 1e-9
        if len(where) < need:
            return None
        counts = Counter(self.shingles[item].tolist())
        held = np.searchsorted(where, np.arange(len(hashes) + 1))  # hits before each position
        starts = np.flatnonzero(held[shingles:] - held[:-shingles] >= need).tolist()
        best = None
        for at in range(0, len(starts), 256):
            block = starts[at:at + 256]
            prints = [weighted_simhash(hashes[s:s + shingles]) for s in block]
            for i, distance in self.within(item, prints):
                start = block[i]
                score = weighted_jaccard(Counter(hashes[start:start + shingles].tolist()), counts)
                if score >= similarity and (best is None or score > best[3]):
                    best = (start, width, distance, score)
        return best


def item_blocks(benchmark: DataFrame, max_items: int = MAX_ITEMS) -> list[list]:
    """The items in blocks of at most ``max_items`` and MAX_ITEM_CHARS characters
    (or one item), so that an index has a bounded size."""
    items = (benchmark.where("text IS NOT NULL")
             .select(F.col("item_id").cast("long"), F.col("text").cast("string"))
             .orderBy("item_id", "text").toLocalIterator())
    blocks, chars = [], 0
    for item_id, text in items:
        if not blocks or len(blocks[-1]) == max_items or chars + len(text) > MAX_ITEM_CHARS:
            blocks.append([])
            chars = 0
        blocks[-1].append((item_id, text))
        chars += len(text)
    return blocks


def _indexes(docs: DataFrame, benchmark: DataFrame, shingle: int, radius: int, max_items: int):
    return [docs.sparkSession.sparkContext.broadcast(ItemIndex(items, shingle, radius))
            for items in item_blocks(benchmark, max_items)]


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                          similarity: float = SIMILARITY, radius: int = RADIUS,
                          max_items: int = MAX_ITEMS) -> DataFrame:
    """One row per document and benchmark item that it holds: the best window."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
    names = ["doc_id", "item_id", "first_word", "n_words", "distance", "similarity"]

    def scan(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(doc, *found) for doc, text in zip(batch.column(0).to_pylist(),
                                                           utf8(batch, "text"), strict=True)
                        for found in index.value.matches(text, similarity)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names)
        return run

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    found = [narrow.transform(map_arrow, scan(index), RESULT_SCHEMA)
             for index in _indexes(docs, benchmark, shingle, radius, max_items)]
    return (reduce(DataFrame.unionByName, found) if found
            else docs.sparkSession.createDataFrame([], RESULT_SCHEMA))


def decontaminate(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE,
                  similarity: float = SIMILARITY, radius: int = RADIUS,
                  max_items: int = MAX_ITEMS) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    def clean(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.value.matches(text, similarity)
                                             for text in utf8(batch, "text")], pa.bool_()))
        return run

    for index in _indexes(docs, benchmark, shingle, radius, max_items):
        docs = docs.transform(map_arrow, clean(index), docs.schema)
    return docs
