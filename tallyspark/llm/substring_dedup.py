"""Removal of long word passages that an earlier document already has, by
compaction of a de Bruijn graph of word k-mers.

A *window* is ``window`` consecutive words of one document. A word goes if
some window over it also occurs in a document with a smaller ``doc_id``.

Every window holds one *anchor*: the k-mer with the smallest hash in it (the
leftmost of equals). Equal windows have equal anchors, so a window can only
recur where its anchor does. The windows around one anchor occurrence overlap
and form one edge of the graph: the anchor is its node, the words from the
first to the last of these windows its label (``block``). A document is then a
path of edges, about one per ``(window - k) / 2`` words.

1. Nodes seen in one document only cannot hold a repeated window: dropped by
   an aggregate on the node and a join.
2. Nodes all of whose edges have one label do not branch: the whole path is
   the same wherever it occurs, so all its occurrences but those in the first
   document are repeated. No window of it is ever looked at.
3. Where a node branches, one occurrence of each label stands for all others;
   its words are fetched from the source text by coordinates and compared
   window by window.

What an aggregate says of a hot node or label is stored before it is joined, so
that both sides of the join are plain shuffles and Spark can split the key.
Both outcomes are word ranges by document, which a last join brings back to
the texts. Memory per task is one Arrow batch and one document's ranges; a
passage that a third of all documents share is one label, aggregated map-side.

Nulls: a null text has no words; rows without a ``doc_id`` keep all words and
are no one's earlier document. Rows that repeat a ``doc_id`` are one document
for the order (they never remove words from each other). Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import (
    gram_hashes, map_arrow, record_batch, signed, span_hashes, stored, utf8, word_hashes,
)

WINDOW = 50
KMER = 12

EDGE_SCHEMA = "doc_id long, text_id long, node long, label long, first int, last int"
RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string"


def path_edges(words: np.ndarray, window: int, k: int):
    """(node, label, first window, last window) of each edge of a document."""
    n = len(words) - window + 1
    if n <= 0:
        return None
    kmers = gram_hashes(words, k)
    view = np.lib.stride_tricks.sliding_window_view(kmers, window - k + 1)
    anchor = view.argmin(axis=1) + np.arange(n)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(first[1:], n) - 1
    return kmers[anchor[first]], span_hashes(words, first, last + window), first, last


def edge_table(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       utf8(batch, "text"), strict=True):
                found = path_edges(word_hashes(text), window, k)
                if found is not None:
                    node, label, first, last = found
                    parts.append((np.full(len(node), doc, np.int64),
                                  np.full(len(node), mark, np.int64), signed(node), signed(label),
                                  first.astype(np.int32), last.astype(np.int32)))
            if parts:
                yield record_batch(parts, ["doc_id", "text_id", "node", "label", "first", "last"])

    return (keyed(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
            .transform(map_arrow, edges, EDGE_SCHEMA))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64("text").alias("text_id"), F.col("text").cast("string"))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """(doc_id, text_id, ranges): window ranges [first, last] whose windows
    all start in an earlier document too."""
    edges = stored(edge_table(docs, window, k), "edges")
    nodes = stored(edges.groupBy("node")
                   .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                        (F.min("label") != F.max("label")).alias("branches"))
                   .where("lo < hi").select("node", "branches"), "nodes")
    edges = stored(edges.join(nodes, "node"), "repeated-edges")

    labels = (edges.groupBy("node", "label", "branches")
              .agg(F.min(F.struct("doc_id", "text_id", "first", "last")).alias("source")))
    verified = _verified(docs, labels.where("branches").select("node", "label", "source.*"), window)
    decided = stored(labels.select("node", "label", F.col("source.doc_id").alias("source_doc"))
                     .join(verified, ["node", "label"], "left"), "decided")
    hits = (edges.join(decided, ["node", "label"])
            .where("doc_id > source_doc OR offsets IS NOT NULL")
            .select("doc_id", "text_id", F.explode(
                F.when(F.col("doc_id") > F.col("source_doc"),
                       F.array(F.struct(F.col("first"), F.col("last"))))
                .otherwise(F.transform("offsets", lambda o: F.struct(
                    (F.col("first") + o).alias("first"),
                    (F.col("first") + o).alias("last"))))).alias("range")))
    # repeated rows of a document give equal ranges; stored, so that the join with it can be split
    return stored(hits.groupBy("doc_id", "text_id").agg(F.collect_set("range").alias("ranges")), "ranges")


def _verified(docs: DataFrame, sources: DataFrame, window: int) -> DataFrame:
    """(node, label, offsets): for branching nodes, the windows of a label's
    first occurrence that an earlier document has, read at the source."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, edges, text in zip(batch.column(0).to_pylist(), batch.column(2),
                                        utf8(batch, "text"), strict=True):
                words = word_hashes(text)
                node, label, first, last = (x.to_numpy(zero_copy_only=False)
                                            for x in edges.values.flatten())
                count = last - first + 1
                which = np.repeat(np.arange(len(node)), count)
                offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                start = first[which] + offset
                parts.append((np.full(len(which), doc, np.int64), node[which], label[which],
                              offset.astype(np.int32),
                              signed(span_hashes(words, start, start + window))))
            if parts:
                yield record_batch(parts, ["doc_id", "node", "label", "offset", "content"])

    wanted = (sources.groupBy("doc_id", "text_id")
              .agg(F.collect_list(F.struct("node", "label", "first", "last")).alias("edges")))
    checked = stored(
        keyed(docs).join(wanted, ["doc_id", "text_id"]).dropDuplicates(["doc_id", "text_id"])
        .select("doc_id", "text", "edges")
        .transform(map_arrow, windows, "doc_id long, node long, label long, offset int, content long"),
        "windows")
    earliest = stored(checked.groupBy("node", "content")
                      .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                      .where("lo < hi").select("node", "content", "lo"), "earliest")
    return (checked.join(earliest, ["node", "content"]).where("doc_id > lo")
            .groupBy("node", "label").agg(F.collect_list("offset").alias("offsets")))


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, k: int = KMER) -> DataFrame:
    """One row per document: word counts and the kept words, joined by one space."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, left = [], [], []
            for ranges, text in zip(batch.column(2), utf8(batch, "text"), strict=True):
                words = text.split()
                cover = np.zeros(len(words) + 1, np.int64)
                if ranges.is_valid:
                    first, last = (x.to_numpy(zero_copy_only=False) for x in ranges.values.flatten())
                    np.add.at(cover, first, 1)
                    np.add.at(cover, last + window, -1)
                keep = np.cumsum(cover)[:-1] == 0
                total.append(len(words))
                removed.append(int(len(words) - keep.sum()))
                left.append(b" ".join(words if not removed[-1] else
                                      [words[i] for i in np.flatnonzero(keep)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(left, pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    ranges = repeated_ranges(docs, window, k)
    return (keyed(docs).join(ranges, ["doc_id", "text_id"], "left")
            .select("doc_id", "text", "ranges").transform(map_arrow, kept, RESULT_SCHEMA))
