"""Language identification with unigram piece models, summed over segmentations.

Each language has a probability for every piece of a fixed public vocabulary
(of byte pieces, named by a parameter). A word's probability in a language is
the sum over all ways to cut it into pieces, by a forward pass over the
lattice of pieces; a text's is the product over its words. The prediction is
the likeliest language, the score its posterior probability.

The probabilities are learned by expectation maximisation on a bounded sample:
about ``sample_docs`` documents of each language, chosen by a hash of their
id among those that may be learned from. The sample's distinct words are
counted by Spark; in each round its tasks return expected piece counts
(forward-backward), summed by Spark, and the driver gets one number per
language and piece. The model (languages x vocabulary) is all that is
broadcast. Every document is scored whole, in one pass without a shuffle;
words are scored once per task batch and kept in a bounded memo.

A posterior only says which language is least bad. ``keep_identified`` also asks
how well it fits: the gain in log probability a byte over the untrained model (all
pieces alike) must be at least MIN_FIT of the language's own gain over its sample.

Words are runs of bytes other than ASCII non-letters, lower-cased, with a
space in front, of any length: longer ones than BLOCK_BYTES are summed one at a
time, with a rescaled alpha. Of languages that score alike the first in
code-point order is predicted. Text that is null or has no letter is ``und`` with score 0, as is all
text where there is nothing to learn from. A null ``doc_id`` is neither learned
from nor held out. Rows with a null ``lang`` are only scored. Repeated rows are
learned from once and scored as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, map_pandas, stored
from tallyspark.llm.vocabulary import Trie, load_trie

SAMPLE_DOCS = 1000
ROUNDS = 3
SMOOTHING = 0.01
BLOCK_BYTES = 32  # longer words are summed one at a time
MEMO_WORDS = 100_000
BLOCK_DOCS = 256
MIN_SCORE = 0.5
MIN_FIT = 0.15

RESULT_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 0x20 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_LETTERS).split()


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Lattice:
    """All pieces of a set of words: (start, rows, end, piece) by start and length."""

    def __init__(self, trie: Trie, words: list[bytes]) -> None:
        padded = [b" " + w for w in words]
        self.length = np.fromiter(map(len, padded), np.int64, len(padded))
        self.width = int(self.length.max(initial=0))
        letters = np.frombuffer(b"".join(w.ljust(self.width, b"\0") for w in padded), np.uint8)
        letters = letters.reshape(len(padded), self.width)
        self.arcs = []
        for start in range(self.width):
            rows = np.flatnonzero(self.length > start)
            node = np.zeros(len(rows), np.int32)
            for end in range(start + 1, self.width + 1):
                node = trie.step(node, letters[rows, end - 1])
                alive = (node > 0) & (self.length[rows] >= end)
                rows, node = rows[alive], node[alive]
                if not len(rows):
                    break
                piece = trie.piece[node]
                known = piece >= 0
                if known.any():
                    self.arcs.append((start, rows[known], end, piece[known]))

    def forward(self, weight) -> np.ndarray:
        """alpha[position, word, ...]; weight(rows, pieces) is a piece's probability."""
        alpha = None
        for start, rows, end, piece in self.arcs:
            p = weight(rows, piece)
            if alpha is None:
                alpha = np.zeros((self.width + 1, len(self.length), *p.shape[1:]))
                alpha[0] = 1
            alpha[end, rows] += alpha[start, rows] * p
        return alpha

    def expected(self, weight, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, pieces, expected occurrences in ``count`` occurrences of the words)."""
        alpha = self.forward(weight)
        every = np.arange(len(self.length))
        total = alpha[self.length, every]
        beta = np.zeros_like(alpha)
        beta[self.length, every] = 1
        for start, rows, end, piece in reversed(self.arcs):
            after = weight(rows, piece) * beta[end, rows]
            beta[start, rows] += after
            yield rows, piece, alpha[start, rows] * after / total[rows] * count[rows]


class LongWord:
    """Sums over the segmentations of one word of any length. Alpha is kept for
    as many positions as a piece is long and rescaled as it shrinks."""

    def __init__(self, trie: Trie, word: bytes) -> None:
        letters = np.frombuffer(b" " + word, np.uint8)
        self.length = len(letters)
        starts, node, found = np.arange(self.length), np.zeros(self.length, np.int32), []
        for size in range(1, self.length + 1):
            node = trie.step(node, letters[starts + size - 1])
            alive = node > 0
            starts, node = starts[alive], node[alive]
            known = trie.piece[node] >= 0
            found.append((starts[known], np.full(known.sum(), size), trie.piece[node[known]]))
            more = starts + size < self.length
            starts, node = starts[more], node[more]
            if not len(starts):
                break
        start, size, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(start, kind="stable")
        self.start, self.size, self.piece = start[order], size[order], piece[order]

    def _logs(self, at: np.ndarray, size: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log of the sum over all ways from the first position to each, by
        arcs in the order of their start."""
        cut = np.searchsorted(at, np.arange(self.length + 1))
        window = np.zeros((int(self.size.max()) + 1, *p.shape[1:]))
        window[0] = 1
        log = np.zeros((self.length + 1, *p.shape[1:]))
        scale = np.zeros(p.shape[1:])
        for i in range(self.length):
            here = window[0].copy()
            log[i] = scale + np.log(here)
            arcs = slice(cut[i], cut[i + 1])
            window[size[arcs]] += here * p[arcs]
            window[:-1] = window[1:]
            window[-1] = 0
            most = window.max(axis=0)
            if (most < 1e-100).any():
                window /= most
                scale = scale + np.log(most)
        log[-1] = scale + np.log(window[0])
        return log

    def log_likelihood(self, table: np.ndarray) -> np.ndarray:
        """By column of the table (pieces x columns)."""
        return self._logs(self.start, self.size, table[self.piece])[-1]

    def expected(self, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, expected occurrences of each in one occurrence of the word)."""
        p = column[self.piece]
        alpha = self._logs(self.start, self.size, p)
        back = self.length - self.start - self.size  # the word from its end
        order = np.argsort(back, kind="stable")
        beta = self._logs(back[order], self.size[order], p[order])[::-1]
        return self.piece, np.exp(alpha[self.start] + np.log(p) + beta[self.start + self.size] - alpha[-1])


class Model:
    """Log probabilities of words in each language."""

    def __init__(self, languages: list[str], table: np.ndarray) -> None:
        # table: pieces x languages, or one column more: the background
        self.languages, self.table = languages, table
        self.memo: dict[bytes, int] = {}
        self.scores = np.zeros((1024, table.shape[1]))

    def __getstate__(self) -> dict:
        return {"languages": self.languages, "table": self.table}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def _learn(self, trie: Trie, words: list[bytes]) -> None:
        at = len(self.memo)
        if at + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros(
                (at + 2 * len(words), self.scores.shape[1]))])
        short = [i for i, w in enumerate(words) if len(w) <= BLOCK_BYTES]
        logs = np.empty((len(words), self.table.shape[1]))
        for a in range(0, len(short), 8192):
            some = short[a:a + 8192]
            lattice = Lattice(trie, [words[i] for i in some])
            alpha = lattice.forward(lambda rows, piece: self.table[piece])
            logs[some] = np.log(alpha[lattice.length, np.arange(len(some))])
        for i in set(range(len(words))).difference(short):
            logs[i] = LongWord(trie, words[i]).log_likelihood(self.table)
        self.scores[at:at + len(words)] = logs
        self.memo.update(zip(words, range(at, at + len(words)), strict=True))

    def log_likelihoods(self, trie: Trie, docs: list[list[bytes]]) -> np.ndarray:
        """documents x columns of the table."""
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.scores = {}, np.zeros((1024, self.table.shape[1]))
        new = {w for words in docs for w in words if w not in self.memo}
        if new:
            self._learn(trie, sorted(new))
        out = np.zeros((len(docs), self.table.shape[1]))
        for i, words in enumerate(docs):
            if words:
                out[i] = self.scores[list(map(self.memo.__getitem__, words))].sum(axis=0)
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, sample_docs: int) -> DataFrame:
    """(lang, text): about ``sample_docs`` whole documents of each language."""
    fit = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                     & F.col("lang").isNotNull())
    sizes = fit.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return fit.select("lang", "text").limit(0)
    scale = 1 << 30
    bound = F.create_map(*[F.lit(x) for r in sizes
                           for x in (r["lang"], min(scale, scale * sample_docs // r["count"]))])
    return (fit.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale)) < bound[F.col("lang")])
            .where("text IS NOT NULL").select("lang", "doc_id", "text").distinct())


def train(docs: DataFrame, ranks: str, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> Model:
    return _train(docs, ranks, sample_docs, rounds)[0]


def _train(docs: DataFrame, ranks: str, sample_docs: int, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and its sample as (lang, word, n)."""
    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen = Counter()
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                seen.update((lang, w) for w in words_of(text))
            yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "word", "n"])

    words = stored(_sample(docs, sample_docs)
                   .transform(map_pandas, count_words, "lang string, word binary, n long")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "sample-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    pieces = len(load_trie(ranks).pieces)
    table = np.full((pieces, len(languages)), 1 / pieces)
    for _ in range(rounds if languages else 0):
        counts = np.full(table.shape, SMOOTHING)
        for r in _expected(words, ranks, languages, table).collect():
            counts[r["piece"], r["language"]] += r["n"]
        table = counts / counts.sum(axis=0)
    return Model(languages, table), words


def _expected(words: DataFrame, ranks: str, languages: list[str], table: np.ndarray) -> DataFrame:
    shared = words.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, table = load_trie(ranks), shared.value
        number = {lang: i for i, lang in enumerate(languages)}
        total = np.zeros(table.shape)
        for pdf in batches:
            long = pdf["word"].map(len) > BLOCK_BYTES
            for lang, word, n in pdf[long].itertuples(index=False):
                piece, times = LongWord(trie, bytes(word)).expected(table[:, number[lang]])
                np.add.at(total, (piece, number[lang]), times * n)
            pdf = pdf[~long]
            for at in range(0, len(pdf), 8192):
                part = pdf[at:at + 8192]
                language = part["lang"].map(number).to_numpy(np.int64)
                lattice = Lattice(trie, [bytes(w) for w in part["word"]])
                for rows, piece, n in lattice.expected(
                        lambda rows, piece, of=language: table[piece, of[rows]],
                        part["n"].to_numpy(np.float64)):
                    np.add.at(total, (piece, language[rows]), n)
        piece, language = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "language": language, "n": total[piece, language]})

    return (words.transform(map_pandas, run, "piece int, language int, n double")
            .groupBy("piece", "language").agg(F.sum("n").alias("n")))


def _bytes(words: list[bytes]) -> int:
    """Bytes that are scored: each word has a space in front."""
    return sum(map(len, words)) + len(words)


def _least_fit(model: Model, words: DataFrame, ranks: str, min_fit: float) -> np.ndarray:
    """The least gain a byte over the background with which a text counts as in
    each language. The model has a background column."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, trie = shared.value, load_trie(ranks)
        number = {lang: i for i, lang in enumerate(model.languages)}
        for pdf in batches:
            known = [[bytes(w)] for w in pdf["word"]]
            logs = model.log_likelihoods(trie, known)
            gain = logs[np.arange(len(known)), pdf["lang"].map(number).to_numpy(np.int64)] - logs[:, -1]
            out = pd.DataFrame({"lang": pdf["lang"], "gain": gain * pdf["n"], "bytes": pdf["n"] * [*map(_bytes, known)]})
            yield out.groupby("lang", as_index=False).sum()

    own = {r["lang"]: r["gain"] / r["bytes"] for r in
           words.transform(map_pandas, run, "lang string, gain double, bytes long")
           .groupBy("lang").agg(F.sum("gain").alias("gain"), F.sum("bytes").alias("bytes")).collect()}
    fit = np.array([own[lang] for lang in model.languages])
    return fit - (1 - min_fit) * abs(fit)


def _predict(model, ranks: str, texts: pa.Array, least: np.ndarray | None = None
             ) -> tuple[list[str], np.ndarray]:
    """Languages and scores, a block of texts at a time. ``least`` belongs to a model with a background: texts that fit worse are ``und``."""
    trie = load_trie(ranks)
    names, scores = [], []
    for at in range(0, len(texts), BLOCK_DOCS):
        block = texts.slice(at, BLOCK_DOCS).to_pylist()
        known = np.array([bool(model.languages) and has_letter(t) for t in block], bool)
        if not model.languages:
            names += ["und"] * len(block)
            scores.append(np.zeros(len(block)))
            continue
        words = [words_of(t) if k else [] for t, k in zip(block, known, strict=True)]
        logs = model.log_likelihoods(trie, words)
        if least is not None:
            logs, background = logs[:, :-1], logs[:, -1]
        best = logs.argmax(axis=1)
        if least is not None:
            known &= logs.max(axis=1) - background >= least[best] * [*map(_bytes, words)]
        odds = np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        names += [model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
        scores.append(np.where(known, 1 / odds, 0.0))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def identify(docs: DataFrame, ranks: str, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, ranks, sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _predict(model.value, ranks, batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores)],
                ["doc_id", "held_out", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
            .transform(map_arrow, run, RESULT_SCHEMA))


def keep_identified(docs: DataFrame, ranks: str, min_score: float = MIN_SCORE,
                    sample_docs: int = SAMPLE_DOCS, min_fit: float = MIN_FIT) -> DataFrame:
    """The documents in a learned language, with all their columns: those that
    are ``und``, score below ``min_score`` or fit their language worse than
    ``min_fit`` of what its sample does go."""
    trained, words = _train(docs, ranks, sample_docs)
    pieces = len(trained.table)
    trained = Model(trained.languages, np.hstack([trained.table, np.full((pieces, 1), 1 / pieces)]))
    least = _least_fit(trained, words, ranks, min_fit) if trained.languages else None
    model = docs.sparkSession.sparkContext.broadcast(trained)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = _predict(model.value, ranks, batch.column(at), least)
            yield batch.filter(pa.array([n != "und" and s >= min_score
                                         for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return docs.transform(map_arrow, run, docs.schema)
