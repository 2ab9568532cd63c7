"""Spelling variants against plain comparisons of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import queries
from tallyspark.llm import spelling_variants as S
from tests.llm.helpers import awkward, documents, no_documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def near(words):
    """Pairs one edit apart, through the texts that are left when a letter goes."""
    found = {w: set() for w in words}
    holes, places = {}, {}
    for word in words:
        for i in range(len(word)):
            holes.setdefault(word[:i] + word[i + 1:], set()).add(word)
            places.setdefault((i, word[:i] + word[i + 1:]), set()).add(word)
    for word in words:
        for longer in holes.get(word, ()):
            found[word].add(longer)
            found[longer].add(word)
    for same in places.values():
        for a in same:
            found[a] |= same - {a}
    return found


def plain(rows):
    n = counted(rows)
    out = {}
    pairs = near(n)
    for word in n:
        best = min(pairs[word], key=lambda w: (-n[w], w), default=None)
        out[word] = best if best is not None and n[best] >= 5 * n[word] else None
    found = set()
    for word, form in out.items():
        root = word
        while out[root] is not None:
            root = out[root]
        found.add((word, form, root, n[word], len(pairs[word]), n.get(form)))
    return found


def as_set(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_against_plain_comparison(spark, size):
    path = f"/root/testdata/{size}"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    want = plain([tuple(r) for r in rows])
    assert len(want) > 100 and any(r[1] for r in want)
    assert as_set(queries.op13_spelling_variants(spark, path)) == want


def test_one_edit_against_plain_distance():
    rng = random.Random(3)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(1, 7)))
        b = "".join(rng.choice("ab") for _ in range(len(a) + rng.choice([-1, 0, 1])))
        if b:
            assert S.one_edit(S._letters([a]), S._letters([b])).tolist() == [distance(a, b) == 1]


def test_small_tiles_crowded_cells_and_chains(spark):
    """One cell holds most words, split into many tiles; forms make chains."""
    rng = random.Random(8)
    words = {"".join(rng.sample("abcdefgh", 8)): rng.choice([5, 5, 6, 30]) for _ in range(600)}
    words |= {"aaaaaaaa" + "b" * i: 5 ** (i + 1) for i in range(5)}
    words |= {w[:3] + "é" + w[4:]: 7 for w in list(words)[:150]}
    texts = [" ".join([w] * n) for w, n in words.items()]
    docs = documents(spark, texts)
    want = plain([(i, t) for i, t in enumerate(texts)])
    assert any(root != form for _, form, root, *_ in want if form)
    assert as_set(S.variants(docs, tile=37)) == want
    counted_words = spark.createDataFrame(list(counted(enumerate(texts)).items()), "word string, n long")
    for groups in (1, 2, 7):
        got = {(r.word, r.n_near) for r in S.near_words(counted_words, 50, groups).collect()}
        assert got == {(w, k) for w, _, _, _, k, _ in want}


def test_very_long_words_and_many_equal_letters(spark):
    long = "ab" * 1200
    texts = [" ".join([long] * 25), " ".join([long + "c"] * 5), " ".join([long[:-1]] * 5), "q" * 2100 + " "] * 5
    rows = list(enumerate(texts))
    assert as_set(S.variants(documents(spark, texts))) == plain(rows)


def test_letters_at_the_edges(spark):
    texts = ["÷×ÿÀÉéß " * 6, "÷×ÿÀÉés " * 30, "naïveté NAÏVETÉ naÏvetÉ " * 9, "ABCDEF_abcdef1abcdef' abcdeg" * 5, "Ωmegaaa " * 9]
    assert as_set(S.variants(documents(spark, texts))) == plain(list(enumerate(texts)))


def test_tile_memory_is_bounded_by_its_words():
    tile = S.Tile()
    tile.add(["abcdef", "abcdeg"], np.array([5, 50]))
    for _ in range(3):
        tile.visit(["abcdeh"] * 1000, np.full(1000, 7))
    assert tile.near.tolist() == [3000, 3000] and tile.best == [(-7, "abcdeh")] * 2


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert as_set(S.variants(docs)) == plain(rows)
    assert as_set(S.variants(no_documents(spark))) == set()
