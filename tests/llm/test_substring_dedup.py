"""Repeated passages against a table of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import common, queries
from tallyspark.llm import substring_dedup as D
from tests.llm.helpers import WORD, awkward, documents, no_documents


def brute(rows, window):
    """doc_id -> (words, removed, kept text)."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first: dict = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p:p + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def kept(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()}


@pytest.mark.parametrize("window,k,letters,seed", [(6, 3, "ab", 1), (8, 2, "abcd", 2), (5, 5, "ab", 3), (7, 4, "a", 4)])
def test_random_documents_over_few_words(spark, window, k, letters, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    passage = " ".join(rng.choice("uvwxyz") + str(rng.randint(0, 50)) for _ in range(25))
    texts += [f"{rng.randint(0, 9)} {passage} {rng.randint(0, 9)}" for _ in range(12)]
    got = kept(D.remove_repeated_passages(documents(spark, texts), window, k))
    assert got == brute(enumerate(texts), window)


def test_windows_split_over_two_earlier_documents_stay(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:24]), " ".join(words[16:]), " ".join(words)]
    got = kept(D.remove_repeated_passages(documents(spark, texts), 10, 4))
    assert got == brute(enumerate(texts), 10) and got[2][1] == 40
    got = kept(D.remove_repeated_passages(documents(spark, texts), 12, 4))
    assert got == brute(enumerate(texts), 12)


def test_a_passage_shared_by_most_documents(spark):
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{rng.random()} {rng.random()} {passage} {rng.random()}" for _ in range(200)]
    got = kept(D.remove_repeated_passages(documents(spark, texts)))
    assert got[0][1] == 0 and all(got[i][1] == 60 for i in range(1, 200))


def test_query_against_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"])
           for r in queries.op6_substring_dedup(spark, sf_dir).collect()}
    assert got == {i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for i, (n, m, t) in brute(rows, 50).items()}


def test_awkward_rows(spark):
    rows = D.remove_repeated_passages(awkward(spark)).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["kept_text"] == "" and by[None]["n_removed"] == 0
    assert by[7]["n_removed"] == 60_000 and by[7]["kept_text"] == ""
    earlier = brute([(6, by[6]["kept_text"])], 50)[6]
    assert by[6]["n_words"] == 60_000 and earlier[1] == 0
    assert D.remove_repeated_passages(no_documents(spark)).count() == 0


def test_word_hashes_agree_with_words():
    text = " x\tyy  zebra\x0bé\n\nx yy \x1cq"
    words = text.encode().split()
    start, end = common.word_bounds(text.encode())
    assert [text.encode()[a:b] for a, b in zip(start, end, strict=True)] == words
    hashes = common.word_hashes(text.encode())
    assert (hashes[0] == hashes[4]) and (hashes[1] == hashes[5]) and len(set(hashes.tolist())) == len(set(words))
    grams = common.gram_hashes(np.tile(hashes, 2), 3)
    assert (grams[:5] == grams[7:12]).all() and common.gram_hashes(hashes, 99).size == 0


def test_repeated_rows_give_their_ranges_once(spark):
    text = " ".join(f"w{i}" for i in range(200))
    copies = spark.range(300).select(F.lit(1).alias("doc_id"), F.lit(text).alias("text"))
    docs = documents(spark, [text]).select("doc_id", "text").unionByName(copies)
    (row,) = D.repeated_ranges(docs).collect()
    assert row["doc_id"] == 1 and len(row["ranges"]) == len(set(map(tuple, row["ranges"]))) < 20
