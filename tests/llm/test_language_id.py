"""Segmentation sums against enumeration, and held-out accuracy."""

from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import public_tokenizers

from tallyspark.llm import language_id as L
from tallyspark.llm import queries
from tallyspark.llm.vocabulary import Trie
from tests.llm.helpers import DOCS, awkward, no_documents

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def segmentations(text: bytes, pieces: dict[bytes, int]):
    for cuts in product((0, 1), repeat=len(text) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(text)]
        parts = [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if all(p in pieces for p in parts):
            yield [pieces[p] for p in parts]


def test_forward_and_expected_counts_sum_over_all_segmentations():
    trie = Trie([b" a", b"ab", b"abc", b"bc", b" ab", b"ca"])
    numbers = {p: i for i, p in enumerate(trie.pieces)}
    rng = np.random.default_rng(1)
    table = rng.random((len(trie.pieces), 2))
    words = [b"abca", b"b", b"cabab", b"abc"]
    lattice = L.Lattice(trie, words)
    alpha = lattice.forward(lambda rows, piece: table[piece])
    counts = np.zeros(len(trie.pieces))
    times = np.array([1.0, 2.0, 3.0, 4.0])
    for _, piece, n in lattice.expected(lambda rows, piece: table[piece, 0], times):
        np.add.at(counts, piece, n)
    want = np.zeros(len(trie.pieces))
    for k, word in enumerate(words):
        found = list(segmentations(b" " + word, numbers))
        for language in (0, 1):
            total = sum(np.prod(table[s, language]) for s in found)
            assert np.isclose(alpha[len(word) + 1, k, language], total)
        total = sum(np.prod(table[s, 0]) for s in found)
        for s in found:
            np.add.at(want, s, times[k] * np.prod(table[s, 0]) / total)
    assert np.allclose(counts, want)


def test_long_words_against_exact_sums_and_short_ones():
    from fractions import Fraction

    trie = Trie([b" a", b"ab", b"abc", b"bc", b" ab", b"ca", b"abcabc"])
    numbers = {p: i for i, p in enumerate(trie.pieces)}
    rng = np.random.default_rng(4)
    table = rng.random((len(trie.pieces), 3)) * 1e-9
    for word in (b"abcab" * 40, b"q" * 300, b"abc"):
        text = b" " + word
        for c in range(3):
            p = {piece: Fraction(float(table[i, c])) for piece, i in numbers.items()}
            sums = [Fraction(1)]
            for end in range(1, len(text) + 1):
                sums.append(sum(sums[end - n] * p[text[end - n:end]] for n in range(1, min(7, end) + 1)
                                if text[end - n:end] in p))
            want = _log(sums[-1].numerator) - _log(sums[-1].denominator)
            assert np.isclose(L.LongWord(trie, word).log_likelihood(table)[c], want, rtol=1e-12)
    lattice = L.Lattice(trie, [b"abcab"])
    counts, other = np.zeros(len(trie.pieces)), np.zeros(len(trie.pieces))
    for _, piece, n in lattice.expected(lambda rows, piece: table[piece, 0], np.array([1.0])):
        np.add.at(counts, piece, n)
    np.add.at(other, *L.LongWord(trie, b"abcab").expected(table[:, 0]))
    assert np.allclose(counts, other)
    pieces, times = L.LongWord(trie, b"abcab" * 100).expected(table[:, 0])
    lengths = np.array([len(p) for p in trie.pieces])
    assert np.isclose((lengths[pieces] * times).sum(), 501) and not np.isnan(times).any()


def _log(x: int) -> float:
    """Natural logarithm of a large integer."""
    shift = max(x.bit_length() - 1000, 0)
    return float(np.log(float(x >> shift))) + shift * float(np.log(2))


def test_every_piece_of_the_vocabulary_is_used():
    import base64

    with open(RANKS, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file}
    assert pieces <= set(L.load_trie(RANKS).pieces) and max(map(len, pieces)) > 12


def test_held_out_accuracy_and_columns_of_the_query(spark, sf_dir):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op9_language_id(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in rows)


def two_languages(spark):
    rows = [(i, ["the house and the garden are near", "das Haus und der Garten sind nah"][i % 2] * 3,
             ["en", "de"][i % 2], "s", 0) for i in range(60)]
    return spark.createDataFrame(rows, DOCS)


def test_labels_of_held_out_rows_are_not_learned(spark):
    df = two_languages(spark)
    held = L.held_out(df.doc_id)
    from pyspark.sql import functions as F

    wrong = df.withColumn("lang", F.when(held, "xx").otherwise(df.lang))
    a = {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in L.identify(df, RANKS).collect()}
    b = {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in L.identify(wrong, RANKS).collect()}
    assert a == b and all(p == ["en", "de"][i % 2] for i, (p, _) in a.items())


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = L.identify(docs, RANKS).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 8))
    assert by[None]["lang_pred"] == "en" and by[None]["held_out"] is False
    odd = two_languages(spark).unionByName(spark.createDataFrame(
        [(100, "12345 !?", "en", "s", 0), (101, "ÄÖÜ ẞ", None, "s", 0), (102, "z" * 5000, "de", "s", 0),
         (103, "日本語", None, None, None)], DOCS))
    by = {r["doc_id"]: r["lang_pred"] for r in L.identify(odd, RANKS).collect()}
    assert by[100] == "und" and {by[101], by[102], by[103]} <= {"en", "de"}
    kept = L.keep_identified(odd, RANKS)
    assert kept.columns == odd.columns and set(range(60)) <= {r["doc_id"] for r in kept.collect()}
    assert 100 not in {r["doc_id"] for r in kept.collect()}
    assert L.identify(no_documents(spark), RANKS).count() == 0
    unlabelled = L.identify(docs.drop("lang").selectExpr("*", "CAST(NULL AS string) AS lang"), RANKS).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"}
