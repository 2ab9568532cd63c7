"""Packing as an exact round trip, and the index against plain BM25."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyspark.llm import packing as P
from tallyspark.llm import queries
from tests.llm.helpers import awkward, documents, no_documents

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(JSON)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check_sequences(rows, window):
    """Gapless offsets; full sequences, or a power of two."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("window,shard", [(16, 4), (1024, 1024), (8, 1)])
def test_round_trip(spark, tokenizer, window, shard):
    rng = random.Random(window)
    texts = [" ".join(rng.choice(["red", "green", "Blütenstaub", "x1", "\n", "..."]) for _ in range(rng.randint(0, 60)))
             for _ in range(70)] + [None, "", "<|endoftext|> as text"]
    rows = P.pack(documents(spark, texts).repartition(3), JSON, RANKS, window, shard).collect()
    check_sequences(rows, window)
    back = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        assert r["start"] == len(back[r["doc_id"]])
        back[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
        assert r["length"] == len(r["ids"]) // 4
    for i, t in enumerate(texts):
        assert back[i] == ids_of(tokenizer, t)
        assert {r["doc_tokens"] for r in rows if r["doc_id"] == i} == {len(back[i])}


def test_ids_equal_the_tokenizers_for_any_text(tokenizer):
    encode = P.TokenIds(JSON, RANKS)
    rng = random.Random(8)
    letters = "ab1é \n\t'.s\x1c　 \u0085字𝄞"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    for text in [*texts, *texts[:200], "it's  we'll", " lead", "trail ", "a <|endoftext|> b"]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == want, repr(text)


def test_index_ranks_by_bm25():
    rng = random.Random(6)
    shard = [np.array([rng.randint(1, 40) for _ in range(rng.randint(3, 30))], "<u4") for _ in range(50)]
    index = P.LexicalIndex(shard, query_terms=1000)
    seed = shard[7]
    mean = sum(map(len, shard)) / len(shard)
    df = Counter(t for x in shard for t in set(x.tolist()))

    def score(doc):
        tf, total = Counter(doc.tolist()), 0.0
        for t in set(seed.tolist()):
            idf = math.log(1 + (len(shard) - df[t] + 0.5) / (df[t] + 0.5))
            total += idf * tf[t] * (P.K1 + 1) / (tf[t] + P.K1 * (1 - P.B + P.B * len(doc) / mean))
        return total

    ranked = index.neighbours(seed)
    scores = [score(shard[i]) for i in ranked]
    assert len(ranked) == sum(score(d) > 0 for d in shard)
    assert all(a >= b - 1e-9 for a, b in zip(scores, scores[1:], strict=False))


def test_statistics_cover_the_corpus_and_every_seed_term_queries(spark):
    rng = random.Random(4)
    texts = [[rng.randint(1, 60) for _ in range(rng.randint(1, 40))] for _ in range(90)]
    encoded = spark.createDataFrame([(i, bytearray(np.array(t, "<u4").tobytes())) for i, t in enumerate(texts)],
                                    "doc_id long, ids binary").repartition(5)
    rests = [t[len(t) // 16 * 16:] for t in texts]
    rests = [t for t in rests if t]
    corpus = P.corpus_of(encoded, 16)
    df = Counter(t for x in rests for t in set(x))
    assert corpus.n == len(rests) and corpus.mean == sum(map(len, rests)) / len(rests)
    assert {t: int(corpus.df[t]) for t in df} == df
    shard = [np.arange(1, 41, dtype="<u4"), *[np.array([t], "<u4") for t in range(1, 41)]]
    index = P.LexicalIndex(shard, P.QUERY_TERMS, corpus)
    assert sorted(index.neighbours(shard[0])) == list(range(41))
    assert np.allclose(index.idf, [math.log(1 + (corpus.n - df[t] + 0.5) / (df[t] + 0.5)) for t in range(1, 41)])


def test_neighbours_fill_a_window_first(spark):
    topics = ["apple pear plum quince " * 2, "bolt nut screw washer " * 2, "cello viola oboe flute " * 2]
    docs = documents(spark, [topics[i % 3] for i in range(30)]).coalesce(1)
    rows = P.pack(docs, JSON, RANKS, window=32).collect()
    together = defaultdict(set)
    for r in rows:
        together[r["sequence_id"]].add(r["doc_id"] % 3)
    assert sum(len(t) == 1 for t in together.values()) >= 0.5 * len(together)


def test_query_covers_the_table(spark, sf_dir, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op7_packing(spark, sf_dir).collect()
    check_sequences(rows, 1024)
    seen: Counter = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        ids = ids_of(tokenizer, texts[r["doc_id"]])
        piece = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(piece)
        assert r["start"] == seen[r["doc_id"]]
        seen[r["doc_id"]] += r["length"]
        if seen[r["doc_id"]] == len(ids):
            texts[r["doc_id"]] = texts.get(r["doc_id"])
    assert set(seen) == set(texts)


def test_awkward_rows(spark):
    rows = P.pack(awkward(spark), JSON, RANKS).collect()
    check_sequences(rows, 1024)
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1
    assert sum(r["doc_id"] is None for r in rows) >= 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 6) == next(r["doc_tokens"] for r in rows if r["doc_id"] == 6)
    assert P.pack(no_documents(spark), JSON, RANKS).count() == 0
