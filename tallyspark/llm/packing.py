"""Lexical retrieval packing of documents into sequences of one length.

Each document becomes its token ids and an end id. Whole windows of a long
document are sequences of their own; what remains of it (less than one window)
is packed with its lexical neighbours. Remainders are taken in shards of at
most ``shard_docs`` consecutive documents of a task. A shard is indexed by
term (token id): an inverted index with BM25 weights, whose document
frequencies and mean length are those of all remainders of the table. The first
unused remainder is the seed of a window; all its terms query the index, and the
unused neighbours fill the window greedily, best first (shard order breaks
ties and follows when neighbours run out). The piece that reaches the end of a
window is cut there; its rest is the seed of the next one, which the last
shard of a task passes on to the following. So every sequence is exactly full,
but for the last tokens of a task, which are cut into sequences of falling
powers of two: nothing is padded.

Retrieval is cut: a seed sees the neighbours of its own shard only, and shards
follow the layout of the files. README lists this as open.

A task holds one shard and one Arrow batch; token ids are stored once, documents
never leave their partition, so hot sources or copies cost nothing extra. Only
counts per term are shuffled.
``sequence_id`` is the partition's number and a counter; a retried task gives
the same rows.

Null and empty texts are the end id alone. Repeated rows and null ids are
packed like any other; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, resident, stored

WINDOW = 1024
SHARD_DOCS = 1024
QUERY_TERMS = None  # all
K1, B = 1.2, 0.75
END_ID = 0
MEMO_ENTRIES = 500_000
MEMO_KEY = 48

RESULT_SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
                 "offset long, ids binary")


class TokenIds:
    """Token ids of whole texts as packed little-endian 32-bit integers.

    The vocabulary never merges across a space between two other characters,
    so a text falls into pieces there; a bounded memo keeps the ids of short
    pieces seen before. Texts that hold a special token's string go to the
    tokenizer whole."""

    _CUT = re.compile(r"(?<=\S)(?= \S)")

    def __init__(self, tokenizer_json: str, ranks: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN

        self.tokenizer_json, self.whole = tokenizer_json, None
        with open(tokenizer_json, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encode = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table,
                                        special_tokens={}).encode_ordinary
        self.width = np.zeros(max(table.values()) + 1, np.int64)  # bytes of each token
        self.width[list(table.values())] = list(map(len, table))
        self.memo: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.encode(text), "<u4")

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._special(text)
        first, *rest = text.split(" ")
        out = list(map(self.memo.get, rest))
        missing = [i for i, ids in enumerate(out) if ids is None]
        new = [rest[i] for i in missing]
        if first[-1:].isspace() or any(not p or p[0].isspace() or p[-1].isspace() for p in new):
            return b"".join(self._ids(p).tobytes() for p in self._CUT.split(text))
        if new:  # all new pieces at once; each one's ids end where its bytes do
            ids = self._ids(" " + " ".join(new))
            ends = np.cumsum([len(p.encode()) + 1 for p in new])
            cuts = 4 * (np.searchsorted(np.cumsum(self.width[ids]), ends) + 1)
            packed, start = ids.tobytes(), 0
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            for i, piece, end in zip(missing, new, cuts.tolist(), strict=True):
                out[i] = packed[start:end]
                start = end
                if len(piece) <= MEMO_KEY:
                    self.memo[piece] = out[i]
        return self._ids(first).tobytes() + b"".join(out)

    def _special(self, text: str) -> bytes:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.tokenizer_json)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def token_ids(tokenizer_json: str, ranks: str) -> TokenIds:
    """One per Python worker, whatever the number of its tasks."""
    return resident(("token ids", tokenizer_json, ranks), lambda: TokenIds(tokenizer_json, ranks))


@dataclass(frozen=True)
class Corpus:
    """Number of sequences, their mean length and the document frequency of each term."""
    n: int
    mean: float
    df: np.ndarray


class LexicalIndex:
    """An inverted index of one shard of token sequences with BM25 weights, by
    the figures of a corpus or else of the shard."""

    def __init__(self, shard: list[np.ndarray], query_terms: int | None,
                 corpus: Corpus | None = None) -> None:
        self.n, self.query_terms = len(shard), query_terms
        lengths = np.array([len(x) for x in shard], np.float64)
        doc = np.repeat(np.arange(self.n), lengths.astype(np.int64))
        keys, tf = np.unique(np.concatenate(shard).astype(np.int64) * self.n + doc,
                             return_counts=True)
        self.doc = keys % self.n
        self.terms, self.first, df = np.unique(keys // self.n, return_index=True, return_counts=True)
        self.last = self.first + df
        n, mean, df_all = (corpus.n, corpus.mean, corpus.df[self.terms]) if corpus else (
            self.n, lengths.mean(), df)
        self.idf = np.log(1 + (n - df_all + 0.5) / (df_all + 0.5))
        norm = K1 * (1 - B + B * lengths / mean)
        self.weight = np.repeat(self.idf, df) * tf * (K1 + 1) / (tf + norm[self.doc])

    def neighbours(self, seed: np.ndarray) -> list[int]:
        """Members that share the seed's (heaviest) terms, best first."""
        terms, tf = np.unique(seed, return_counts=True)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        at, tf = at[known], tf[known]
        heavy = at[np.argsort(-self.idf[at] * tf / (tf + K1), kind="stable")[: self.query_terms]]
        spans = [slice(a, b) for a, b in zip(self.first[heavy], self.last[heavy], strict=True)]
        if not spans:
            return []
        score = np.bincount(np.concatenate([self.doc[x] for x in spans]),
                            np.concatenate([self.weight[x] for x in spans]), self.n)
        hit = np.flatnonzero(score)
        return hit[np.argsort(-score[hit], kind="stable")].tolist()


class Packer:
    """Windows of one task. A part is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, task: int, window: int, query_terms: int | None, corpus: Corpus) -> None:
        self.window, self.query_terms, self.corpus = window, query_terms, corpus
        self.next_id = task << 40
        self.open: list[tuple] = []
        self.filled = 0
        self.rows: list[tuple] = []

    def _sequence(self, parts: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in parts:
            self.rows.append((doc_id, start, len(ids), doc_tokens, self.next_id, offset,
                              ids.tobytes()))
            offset += len(ids)
        self.next_id += 1

    def whole_windows(self, doc_id, ids: np.ndarray) -> tuple | None:
        """Emits a document's whole windows; what remains of it is returned."""
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            self._sequence([(doc_id, start, ids[start:start + self.window], len(ids))])
        return (doc_id, whole, ids[whole:], len(ids)) if whole < len(ids) else None

    def _put(self, part: tuple) -> None:
        doc_id, start, ids, doc_tokens = part
        room = self.window - self.filled
        self.open.append((doc_id, start, ids[:room], doc_tokens))
        self.filled += min(room, len(ids))
        if self.filled == self.window:
            self._sequence(self.open)
            self.open, self.filled = [], 0
            if len(ids) > room:
                self._put((doc_id, start + room, ids[room:], doc_tokens))

    def shard(self, parts: list[tuple]) -> None:
        """Packs a shard of remainders; a window may stay open for the next."""
        index = LexicalIndex([p[2] for p in parts], self.query_terms, self.corpus)
        unused = [True] * len(parts)
        at = 0
        while at < len(parts):
            if not self.open:
                if not unused[at]:
                    at += 1
                    continue
                unused[at] = False
                self._put(parts[at])
                continue
            sequence = self.next_id
            for i in index.neighbours(self.open[0][2]):
                if unused[i]:
                    unused[i] = False
                    self._put(parts[i])
                    if self.next_id != sequence:
                        break
            while self.next_id == sequence and at < len(parts):
                if unused[at]:
                    unused[at] = False
                    self._put(parts[at])
                at += 1

    def close(self) -> None:
        """The last open window, cut into sequences of falling powers of two."""
        parts, self.open = self.open[::-1], []
        while self.filled:
            size = 1 << (self.filled.bit_length() - 1)
            self.filled -= size
            sequence = []
            while size:
                doc_id, start, ids, doc_tokens = parts.pop()
                sequence.append((doc_id, start, ids[:size], doc_tokens))
                if len(ids) > size:
                    parts.append((doc_id, start + size, ids[size:], doc_tokens))
                size -= min(size, len(ids))
            self._sequence(sequence)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 7
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(columns[6], pa.binary())],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])


def corpus_of(encoded: DataFrame, window: int) -> Corpus:
    """Counts over the remainders of all documents; one row per term is collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(1, np.int64), 0, 0
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                ids = np.frombuffer(ids, "<u4")
                rest = ids[len(ids) // window * window:]
                if len(rest):
                    terms = np.unique(rest)
                    if terms[-1] >= len(df):
                        df = np.pad(df, (0, int(terms[-1]) + 1 - len(df)))
                    df[terms] += 1
                    n, length = n + 1, length + len(rest)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *terms.tolist()], pa.int64()),
             pa.array([n, length, *df[terms].tolist()], pa.int64())], ["term", "n"])

    found = {r["term"]: r["n"] for r in encoded.select("ids").transform(map_arrow, count, "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n, length = found.pop(-2, 0), found.pop(-1, 0)
    df = np.zeros(max(found, default=0) + 1, np.int64)
    df[list(found)] = list(found.values())
    return Corpus(n, length / max(n, 1), df)


def pack(docs: DataFrame, tokenizer_json: str, ranks: str, window: int = WINDOW,
         shard_docs: int = SHARD_DOCS, query_terms: int | None = QUERY_TERMS) -> DataFrame:
    """One row per piece of a document in a sequence. ``tokenizer_json`` and
    ``ranks`` are two files of one vocabulary, readable on every executor."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer_json, ranks)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = [(encode(t) if t else b"") + end for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    encoded = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
                     .transform(map_arrow, tokens, "doc_id long, ids binary"), "token-ids")
    corpus = docs.sparkSession.sparkContext.broadcast(corpus_of(encoded, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, waiting = Packer(TaskContext.get().partitionId(), window, query_terms, corpus.value), []
        for batch in batches:
            for doc_id, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rest = packer.whole_windows(doc_id, np.frombuffer(ids, "<u4"))
                if rest:
                    waiting.append(rest)
                if len(waiting) == shard_docs:
                    packer.shard(waiting)
                    waiting = []
                if len(packer.rows) >= 2 * shard_docs:
                    yield packer.batch()
        if waiting:
            packer.shard(waiting)
        packer.close()
        yield packer.batch()

    return encoded.transform(map_arrow, run, RESULT_SCHEMA)
