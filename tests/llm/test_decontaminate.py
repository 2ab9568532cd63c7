"""Benchmark passages against every window of every document."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tallyspark.llm import decontaminate as D
from tallyspark.llm import queries
from tests.llm.helpers import WORD, awkward, documents, no_documents

ITEMS = "item_id bigint, text string"


def shingles(words, size=5):
    size = min(size, len(words))
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def brute(texts, items):
    """(doc, item) -> best weighted Jaccard over item-sized windows, where at least 0.8."""
    found = {}
    for i, text in enumerate(texts):
        words = WORD.findall((text or "").lower())
        for k, item in enumerate(items):
            wanted = WORD.findall((item or "").lower())
            width = min(len(wanted), len(words))
            if not width or (len(wanted) < 5 and width < len(wanted)):
                continue
            b = shingles(wanted)
            for s in range(len(words) - width + 1):
                a = shingles(words[s:s + width], min(5, len(wanted)))
                both = sum((a & b).values())
                score = both / (a.total() + b.total() - both)
                if score >= 0.8 and score > found.get((i, k), 0):
                    found[i, k] = score
    return found


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + str(rng.randint(0, 300))
    items = [" ".join(word() for _ in range(n)) for n in (13, 20, 30, 45, 60, 3, 4, 5, 6)]
    texts = []
    for n in range(70):
        body = [word() for _ in range(rng.randint(0, 60))]
        if n % 2:
            planted = items[rng.randrange(len(items))].split()
            for _ in range(rng.randint(0, 2)):  # edits
                at = rng.randrange(len(planted))
                planted[at:at + 1] = rng.choice([[], [word()], [planted[at], word()]])
            body[rng.randint(0, len(body)):0] = planted
        texts.append("\n ".join(body).upper() if n % 3 else "  ".join(body))
    return texts, items


@pytest.mark.parametrize("seed,max_items", [(1, 1000), (2, 2)])
def test_matches_brute_force(spark, seed, max_items):
    texts, items = corpus(seed)
    bench = spark.createDataFrame(list(enumerate(items)), ITEMS)
    rows = D.contaminated_passages(documents(spark, texts), bench, max_items=max_items).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    want = brute(texts, items)
    assert set(got) <= set(want) and len(rows) == len(got)
    exact = {k for k, s in want.items() if s == 1.0}
    assert exact <= set(got) and len(got) >= 0.95 * len(want)  # the rest lie beyond the SimHash radius
    assert all(abs(got[k] - want[k]) < 1e-9 for k in exact)
    clean = {r["doc_id"] for r in D.decontaminate(documents(spark, texts), bench, max_items=max_items).collect()}
    assert clean == set(range(len(texts))) - {i for i, _ in got}


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(3)
    items = [(i, " ".join(f"w{rng.randint(0, 999)}" for _ in range(20))) for i in range(17)]
    index = D.ItemIndex(items, 5, 11)
    for item in range(17):
        own = int(index.prints[item])
        queries_ = []
        for bits in range(16):
            q = own
            for b in rng.sample(range(64), bits):
                q ^= 1 << b
            queries_.append(q)
        assert index.within(item, queries_) == [(n, n) for n in range(12)]


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three four"), (None, "a text without an id"),
                                   (3, "one two three four")], ITEMS).selectExpr("*", "1 AS doc_id")
    rows = D.contaminated_passages(awkward(spark), bench).collect()
    assert sorted((r["doc_id"] or -1, r["item_id"] or -1) for r in rows) == [(-1, -1)] + [(4, 3)] * 4 + [(5, 3)] * 2
    kept = D.decontaminate(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns and kept.count() == 6
    nothing = spark.createDataFrame([], ITEMS)
    assert D.contaminated_passages(awkward(spark), nothing).count() == 0
    assert D.decontaminate(awkward(spark), nothing).count() == 10
    assert D.contaminated_passages(no_documents(spark), bench).count() == 0


def test_query_finds_planted_items(spark, sf_dir):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_decontamination(spark, sf_dir).collect()
    got = {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(d, i) for d, t in texts.items() for i, x in items.items() if x in t} <= got
    for r in rows:
        words = WORD.findall(texts[r["doc_id"]].lower())[r["first_word"]:r["first_word"] + r["n_words"]]
        a, b = shingles(words), shingles(WORD.findall(items[r["item_id"]].lower()))
        assert sum((a & b).values()) / sum((a | b).values()) == pytest.approx(r["similarity"]) and r["similarity"] >= 0.8


def test_simhash_of_shingles_is_the_majority():
    hashes = np.array([0b0111, 0b0110, 0b0100], np.uint64)
    assert D.weighted_simhash(hashes) == 0b0110
