"""A quality score of texts: a generalised additive model with pairwise terms.

Each feature of a text (length, shares of kinds of characters, repetition,
lines) has a lookup table over its bins, and so has each of a few pairs of
features; the score is the logistic function of the sum of the table entries.
The tables are learned by cyclic boosting: round after round, each feature in
turn gets a shallow tree over its bins, fitted to the current residuals and
added to its table with a small rate; then the pairs that reduce the loss most
get trees of one cut in either feature in the same way.

The model is fitted on the driver to a bounded sample of labelled documents:
about ``sample_docs`` distinct ids, chosen by a hash of the id among those
that may be learned from, of which the driver gets the features alone. Repeated
label rows of an id weigh as often as they occur; of repeated documents one is
learned from. Every document is scored whole, in one pass without a shuffle.

Null and empty texts have all features zero and are scored like any other; very
long ones are read whole, in one task each.
Null labels and ids are not learned from; a null ``doc_id`` is not held out.
Without any label the score is 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, utf8

SAMPLE_DOCS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
RATE = 0.1
LEAVES = 3
THRESHOLD = 0.3

FEATURES = ("log_bytes", "log_words", "word_length", "upper_share", "letter_share", "digit_share",
            "space_share", "stop_share", "comma_share", "other_symbol_share", "pipe_share",
            "byte_entropy", "vocabulary", "top_word_share", "repeat_share", "symbol_end_share",
            "title_share", "line_words", "repeated_line_share", "stop_line_share")

RESULT_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_CLASSES = {"upper": range(65, 91), "letter": [*range(65, 91), *range(97, 123), *range(128, 256)],
            "digit": range(48, 58), "space": [9, 10, 11, 12, 13, 32], "stop": b".", "comma": b",;:",
            "pipe": b"|"}
_MEMBER = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _MEMBER[list(_bytes), _i] = 1
_SYMBOLS = frozenset(b"!#$%&*+/<=>?@\\^_`{|}~")


def features(text: bytes) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = counts[counts > 0] / len(text)
    upper, letter, digit, space, stop, comma, pipe = (counts @ _MEMBER).tolist()
    words = text.split()
    n = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x]
    n_lines = max(len(lines), 1)
    other = len(text) - letter - digit - space - stop - comma
    return [
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, upper / max(letter, 1),
        letter / len(text), digit / len(text), space / len(text), stop / n, comma / n,
        other / len(text), pipe / n, float(-(share * np.log2(share)).sum()),
        np.log1p(len(seen)) / np.log1p(n), max(seen.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n, sum(w[-1] in _SYMBOLS for w in words) / n,
        sum(map(bytes.istitle, words)) / n, n / n_lines, 1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(x.endswith(b".") for x in lines) / n_lines,
    ]


def _leaf_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of a tree of at most ``leaves`` leaves, each a run of bins,
    split greedily where the loss falls most."""
    def value(a: int, b: int) -> float:
        return gradient[a:b].sum() / (weight[a:b].sum() + 1.0)

    cuts = [0, len(gradient)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a < 2:
                continue
            g, w = np.cumsum(gradient[a:b]), np.cumsum(weight[a:b])
            left = g[:-1] ** 2 / (w[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (w[-1] - w[:-1] + 1)
            at = int(left.argmax())
            gain = left[at] - g[-1] ** 2 / (w[-1] + 1)
            if gain > best[0]:
                best = (gain, a + at + 1)
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = value(a, b)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree of one cut in each of two features: values by pair of bins, and
    how far the loss falls."""
    def corner(x: np.ndarray) -> np.ndarray:
        return x.cumsum(0).cumsum(1)

    g, w = corner(gradient), corner(weight)
    def four(x: np.ndarray) -> list[np.ndarray]:
        low = x[:-1, :-1]
        return [low, x[:-1, -1:] - low, x[-1:, :-1] - low, x[-1, -1] - x[:-1, -1:] - x[-1:, :-1] + low]

    gs, ws = four(g), four(w)
    gain = sum(a ** 2 / (b + 1) for a, b in zip(gs, ws, strict=True))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [float(a[i, j] / (b[i, j] + 1)) for a, b in zip(gs, ws, strict=True)]
    out = np.empty_like(gradient)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return out, float(gain[i, j] - g[-1, -1] ** 2 / (w[-1, -1] + 1))


class AdditiveModel:
    """Bin edges and lookup tables of single features and of pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> None:
        weight = np.ones(len(y)) if weight is None else weight
        total = weight.sum()
        good = (weight * y).sum()
        self.base = float(np.log((good + 0.5) / (total - good + 0.5)))
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, quantiles)) if len(y) else np.zeros(0) for c in x.T]
        self.coarse = [e[np.linspace(0, len(e) - 1, min(PAIR_BINS - 1, len(e))).astype(int)]
                       if len(e) else e for e in self.edges]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        if len(y):
            self._fit(x, y, weight)

    @staticmethod
    def _bins(edges: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)]

    def _fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        bins, logit = self._bins(self.edges, x), np.full(len(y), self.base)

        def residual() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-logit))
            return weight * (y - p), weight * p * (1 - p)

        for _ in range(ROUNDS):
            for b, table in zip(bins, self.tables, strict=True):
                g, w = residual()
                step = RATE * _leaf_tree(np.bincount(b, g, len(table)),
                                         np.bincount(b, w, len(table)), LEAVES)
                table += step
                logit += step[b]
        coarse = self._bins(self.coarse, x)

        def cells(i: int, j: int, g: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            shape = len(self.coarse[i]) + 1, len(self.coarse[j]) + 1
            at = coarse[i] * shape[1] + coarse[j]
            return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, w))

        now = residual()
        gains = {p: _quadrants(*cells(*p, *now))[1] for p in combinations(range(len(bins)), 2)
                 if len(self.coarse[p[0]]) and len(self.coarse[p[1]])}
        chosen = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
        self.pairs = {p: np.zeros((len(self.coarse[p[0]]) + 1, len(self.coarse[p[1]]) + 1))
                      for p in chosen}
        for _ in range(ROUNDS // 2):
            for (i, j), table in self.pairs.items():
                step = RATE * _quadrants(*cells(i, j, *residual()))[0]
                table += step
                logit += step[coarse[i], coarse[j]]

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.base)
        for b, table in zip(self._bins(self.edges, x), self.tables, strict=True):
            logit += table[b]
        coarse = self._bins(self.coarse, x)
        for (i, j), table in self.pairs.items():
            logit += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-logit))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> AdditiveModel:
    labelled = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                             & ~held_out(F.col("doc_id")))
                .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
                .agg(F.count("*").alias("n"), F.sum(F.col("quality").cast("double")).alias("good")))
    scale = 1 << 30
    size = max(labelled.count(), 1)
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(scale))
                            < min(scale, scale * sample_docs // size))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(utf8(batch, "text"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(list(values), pa.list_(pa.float64()))],
                ["doc_id", "n", "good", "x"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
            .join(F.broadcast(sample), "doc_id").select("doc_id", "n", "good", "text")
            .transform(map_arrow, measure, "doc_id long, n long, good double, x array<double>")
            .groupBy("doc_id", "n", "good").agg(F.min("x").alias("x")).orderBy("doc_id").collect())
    x = np.array([r["x"] for r in rows], np.float64).reshape(-1, len(FEATURES))
    n, good = (np.array([r[c] for r in rows], np.float64) for c in ("n", "good"))
    return AdditiveModel(x, good / np.maximum(n, 1), n)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                  sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.score(_matrix(utf8(batch, "text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score),
                 pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
            .transform(map_arrow, run, RESULT_SCHEMA))
