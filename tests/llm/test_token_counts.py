"""The longest-match automaton against a plain greedy search."""

from __future__ import annotations

import base64
import random

import public_tokenizers

from tallyspark.llm import queries
from tallyspark.llm import token_counts as T
from tallyspark.llm.vocabulary import Trie
from tests.llm.helpers import awkward, no_documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(pieces: set[bytes], longest: int, text: bytes) -> int:
    at = count = 0
    while at < len(text):
        at += next(n for n in range(min(longest, len(text) - at), 0, -1) if text[at:at + n] in pieces)
        count += 1
    return count


def test_small_vocabularies_over_every_word():
    rng = random.Random(2)
    for _ in range(40):
        pieces = {bytes(rng.choice(b"ab ") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        automaton = T.LongestMatch(Trie(list(pieces)))
        known = pieces | {bytes([b]) for b in range(256)}
        for _ in range(150):
            word = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14)))
            assert automaton.word(word) == greedy(known, 5, b" " + word)


def test_query_against_brute_force(spark, sf_dir):
    with open(RANKS, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file}
    longest = max(map(len, pieces))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in queries.op3_token_counts(spark, sf_dir).collect()}
    assert got == {i: (len(w := t.encode().split()), sum(greedy(pieces, longest, b" " + x) for x in w))
                   for i, t in texts.items()}


def test_awkward_rows(spark):
    rows = T.count_tokens(awkward(spark), RANKS).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in rows}
    assert by[1] == by[2] == by[3] == by[8] == (0, 0)
    assert by[4] == by[5] == (4, 4) and by[6] == by[7] and by[6][0] == 60_000
    assert T.count_tokens(no_documents(spark), RANKS).count() == 0
    assert T.automaton(RANKS).word(b"z" * 200_000) > 1000


def test_separator_lines_take_the_longest_pieces():
    with open(RANKS, "rb") as file:
        pieces = {base64.b64decode(line.split()[0]) for line in file}
    longest = max(map(len, pieces))
    automaton = T.automaton(RANKS)
    words = [c * n for c in (b"-", b"=") for n in range(64, 201)]
    words += [p.strip() for p in pieces if len(p) > 64]
    assert [automaton.word(w) for w in words] == [greedy(pieces, longest, b" " + w) for w in words]
    assert [automaton.word(w) for w in (b"-" * 64, b"=" * 65, b"=" * 80)] == [1, 1, 3]
