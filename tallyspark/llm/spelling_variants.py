"""Spelling variants of words: pairs one edit apart, and the form of each word.

*Words* are counted per task first, so a word that fills a third of the
corpus sends one row per task and flush, and then by one shuffle.

*Blocks.* A word is its letter counts. One inserted or deleted letter moves
their squared distance by one, a replaced letter by two, so near words are at
most two apart and lie in the same or in adjacent length blocks. Length blocks
are cut further: the alphabet is dealt into groups of about equal use, and a
cell is the vector of a word's counts by group. An edit adds one to a group,
takes one from a group, or moves one between two; so the cells that can hold
near words of a cell are known, and there are 1 + g(g + 1) for g groups. More
words give more groups, so cells stay small.

*Gram matrices.* Each tile, at most TILE words of a cell, receives all words
of its own and its adjacent cells, streamed in chunks. One NumPy product of
the two letter-count matrices gives all squared distances of tile and chunk;
pairs at most two apart are verified letter by letter. A word sees all its near
words in its own tile, so its number of near words and the most frequent one
are kept there and no pair leaves the task. A cell larger than a tile is dealt
to several tiles, which its words visit in turn: every pair is compared,
memory stays bounded by the tile and the chunk, and a crowded cell is spread
over many tasks.

*Forms.* A word's form is its near word of largest n (ties: smallest in
code-point order) if that is at least RATIO times as frequent. Counts grow
along forms, so they lead to a root; pointers are doubled in stored rounds,
logarithmic in the longest chain.

Nulls: a null text has no words; a null doc_id is the empty string in the
hash that deletes letters. Repeated rows count each. Words are of the letters
A-Z, a-z and U+00C0 to U+00FF, one byte each in Latin-1, however long; a very
long word makes its tile smaller. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, stored, utf8

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5
DELETE_EVERY = 199

TILE = 2048  # words of a tile
CHUNK = 1024  # visiting words of one product
TILE_BYTES = 1 << 22  # letters of a tile
VERIFIED = 1 << 18  # letters compared at once
FLUSH_WORDS = 300_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
LETTERS = bytes([*range(0x61, 0x7B), *range(0xC0, 0x100)])  # in Latin-1
_INDEX = np.zeros(256, np.intp)
_INDEX[list(LETTERS)] = np.arange(len(LETTERS))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least MIN_LETTERS letters and MIN_COUNT uses,
    after the deletions of the contract."""
    # a run that loses a letter must still be long enough, so shorter ones never matter
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LETTERS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch, "text"), strict=True):
                seed = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for run, n in Counter(runs.findall(text.translate(_LOWER).decode())).items():
                    h = zlib.crc32(run.encode(), seed)
                    if h % DELETE_EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < MIN_LETTERS:
                            continue
                    total[run] += n
                if len(total) >= FLUSH_WORDS:
                    yield _counts(total)
                    total.clear()
        yield _counts(total)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .transform(map_arrow, count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


def _counts(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])


def letter_groups(words: DataFrame, groups: int) -> list[str]:
    """The alphabet in ``groups`` strings of about equal use among ``words``."""
    used = {r[0]: r[1] for r in words.select(F.explode(F.split("word", "")).alias("letter"))
            .groupBy("letter").count().collect()}  # one row per letter
    parts, load = [""] * groups, [0] * groups
    for letter in sorted(LETTERS.decode("latin-1"), key=lambda x: (-used.get(x, 0), x)):
        least = load.index(min(load))
        parts[least] += letter
        load[least] += used.get(letter, 0)
    return parts


def group_number(n_words: int) -> int:
    """Letter groups for a vocabulary: one more per tenfold words."""
    return min(max(len(str(n_words)) - 1, 2), 9)


def _cell(word: Column, parts: list[str]) -> Column:
    """Letters of each group in a word."""
    return F.array(*[F.length(word) - F.length(F.translate(word, part, "")) for part in parts])


def _adjacent(cell: Column, groups: int) -> Column:
    """The cells that one edit can reach, the own one first."""
    def moved(change: dict[int, int]) -> Column:
        return F.array(*[cell[i] + change.get(i, 0) for i in range(groups)])

    ways = [{}, *({i: d} for i in range(groups) for d in (1, -1)),
            *({i: 1, j: -1} for i in range(groups) for j in range(groups) if i != j)]
    return F.array(*[F.concat_ws(",", moved(way).cast("array<string>")) for way in ways])


class Tile:
    """Words of one cell, and the near words found for each. All words are
    added before the first visit."""

    def __init__(self):
        self.words: list[str] = []
        self.n = np.zeros(0, np.int64)
        self.counts: np.ndarray | None = None

    def add(self, words: list[str], n: np.ndarray) -> None:
        self.words += words
        self.n = np.concatenate([self.n, n])

    def _prepare(self) -> None:
        self.size = len(self.words[0])
        self.letters = _letters(self.words)
        self.kinds = np.unique(_INDEX[self.letters])
        self.counts = self._counts(self.letters)
        self.norm = (self.counts ** 2).sum(1)
        self.near = np.zeros(len(self.words), np.int64)
        self.best: list[tuple[int, str] | None] = [None] * len(self.words)

    def _counts(self, letters: np.ndarray) -> np.ndarray:
        """Letter counts by row: the letters of this tile, then all others.
        (Others taken together can only bring two words nearer.)"""
        column = np.full(len(LETTERS), len(self.kinds))
        column[self.kinds] = np.arange(len(self.kinds))
        at = column[_INDEX[letters]] + np.arange(len(letters))[:, None] * (len(self.kinds) + 1)
        exact = np.float32 if letters.shape[1] < 1 << 11 else np.float64
        return np.bincount(at.ravel(), minlength=len(letters) * (len(self.kinds) + 1)).reshape(
            len(letters), -1).astype(exact)

    def visit(self, words: list[str], n: np.ndarray) -> None:
        """Compare with words of one length, at most one letter more or less."""
        if self.counts is None:
            self._prepare()
        letters = _letters(words)
        counts = self._counts(letters)
        product = self.counts @ counts.T
        # |a - b|^2 <= 2, as a product of at least (|a|^2 + |b|^2) / 2 - 1
        mine, other = np.nonzero(product >= (self.norm / 2 - 1)[:, None] + ((counts ** 2).sum(1) / 2)[None])
        step = max(VERIFIED // self.size, 1)
        for at in range(0, len(mine), step):
            i, j = mine[at:at + step], other[at:at + step]
            near = one_edit(self.letters[i], letters[j])
            self._keep(i[near], j[near], words, n)

    def _keep(self, mine: np.ndarray, other: np.ndarray, words: list[str], n: np.ndarray) -> None:
        np.add.at(self.near, mine, 1)
        for i, j in zip(mine.tolist(), other.tolist(), strict=True):
            rank = (-int(n[j]), words[j])
            if self.best[i] is None or rank < self.best[i]:
                self.best[i] = rank

    def result(self) -> pa.RecordBatch:
        """Every word visits its own tile, so there was a visit."""
        form = [None if b is None or -b[0] < RATIO * n else b for b, n in zip(self.best, self.n.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.words, pa.string()), pa.array(self.n), pa.array(self.near),
             pa.array([f and f[1] for f in form], pa.string()),
             pa.array([f and -f[0] for f in form], pa.int64())], ["word", "n", "n_near", "form", "form_n"])


def _letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Runs of rows that agree in cell, tile, visits and size."""
    new = np.zeros(batch.num_rows + 1, bool)
    new[[0, -1]] = True
    for c in range(4) if batch.num_rows > 1 else ():
        column = batch.column(c)
        new[1:-1] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(new).tolist()
    return list(pairwise(cuts))


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one inserted, deleted or
    replaced letter; rows of each array are of one length."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


def near_words(words: DataFrame, tile: int = TILE, groups: int | None = None) -> DataFrame:
    """(word, n, n_near, form, form_n) of each row of ``words`` (word, n):
    distinct words over LETTERS."""
    groups = groups or group_number(words.count())
    parts = letter_groups(words, groups)
    cells = words.withColumn("counts", _cell(F.col("word"), parts)).withColumn(
        "adjacent", _adjacent(F.col("counts"), groups))
    most = F.greatest(F.least(F.lit(tile), F.floor(TILE_BYTES / F.length("word"))), F.lit(1))
    tiles = stored(cells.groupBy(F.col("adjacent")[0].alias("cell"))
                   .agg(F.ceil(F.count("*") / F.min(most)).cast("int").alias("tiles")), "cells")
    visits = (cells.select(F.explode("adjacent").alias("cell"), F.col("adjacent")[0].alias("own"), "word", "n")
              .join(tiles, "cell")
              .withColumn("home", F.when(F.col("cell") == F.col("own"),
                                         F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")))
              .select("cell", "home", "word", "n", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")))
    lives = F.col("home").eqNullSafe(F.col("tile"))
    # a word that lives in a tile comes first, and visits it too
    rows = visits.select("cell", "tile", F.explode(F.when(lives, F.array(F.lit(False), F.lit(True)))
                                                   .otherwise(F.array(F.lit(True)))).alias("visits"),
                         F.length("word").alias("size"), "word", "n")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, home = None, None
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for start, end in _runs(batch):
                cell, tile, visits, size = (batch.column(c)[start].as_py() for c in range(4))
                if (cell, tile) != at:
                    if home:
                        yield home.result()
                    at, home = (cell, tile), None
                if not visits:
                    home = home or Tile()
                    home.add(words[start:end], n[start:end])
                elif home:  # a tile may have no word of its own
                    step = max(min(CHUNK, TILE_BYTES // size), 1)
                    for i in range(start, end, step):
                        home.visit(words[i:min(i + step, end)], n[i:min(i + step, end)])
        if home:
            yield home.result()

    keys = ["cell", "tile"]
    return (rows.repartition(*keys).sortWithinPartitions(*keys, "visits", "size")
            .transform(map_arrow, compare, "word string, n long, n_near long, form string, form_n long"))


def roots(forms: DataFrame) -> DataFrame:
    """``forms`` (word, form, ...) with ``root``, the end of each word's forms."""
    links = stored(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(onward, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return forms.join(links.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    words = stored(word_counts(docs), "words")
    forms = stored(near_words(words, tile), "forms")
    return roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
