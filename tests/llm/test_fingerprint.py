"""Fingerprints: homomorphism, equality, edited texts and successors."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from tallyspark.llm import fingerprint as G
from tallyspark.llm import queries
from tests.llm.helpers import awkward, documents, no_documents


def lanes(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.select("i", G.as_text(G.fingerprint(F.col("text"))).alias("f")).orderBy("i").select("f").collect()]


def test_order_of_paragraphs_does_not_matter_but_their_number_does(spark):
    a, b, c, d = lanes(spark, "red apples fall\ngreen pears hang low", "green pears hang low\nred apples fall",
                       "red apples fall\nred apples fall\ngreen pears hang low", "red apples fall green pears hang low")
    assert a == b and len({a, c, d}) == 3


def test_insertion_and_deletion(spark):
    df = spark.createDataFrame([("one two three four\nfive six", "seven eight nine ten\nfive six",
                                 "five six\none two three four\nseven eight nine ten\nfive six")],
                               "a string, b string, ab string")
    fa, fb, fab = (G.fingerprint(F.col(c)) for c in ("a", "b", "ab"))
    row = df.select(*[G.as_text(f) for f in (fab, G.combine(fa, fb), fa, G.without(fab, fb))]).first()
    assert row[0] == row[1] and row[2] == row[3]


def test_counts_over_many_blocks_are_exact(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(2500)), lambda i: F.xxhash64(i)).alias("h"))
    row = df.select("h", G._counts(F.col("h")).alias("c")).first()
    fields = [sum(h >> (bit + G.FIELD * k) & 1 for h in row["h"]) for bit in range(G.FIELD) for k in range(G.SHARED)]
    assert list(row["c"]) == fields


def test_likeness_follows_what_is_shared(spark):
    words = [f"w{i * 7919 % 5003}" for i in range(2000)]
    half = [f"v{i}" for i in range(1000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[:1000] + half), " ".join(f"u{i}" for i in range(2000)))],
                               "a string, half string, other string")
    fa, fh, fo = (G.fingerprint(F.col(c)) for c in ("a", "half", "other"))
    row = df.select(G.likeness(fa, fa), G.likeness(fa, fh), G.likeness(fa, fo)).first()
    assert row[0] == 1.0 and 0.25 < row[1] < 0.75 and row[2] < 0.45


def expected(rows):
    out = {}
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        n = len(t) // 4
        out[i] = (len(t), t[:len(t) - n] + following[:n])
    return out


def test_edited_texts_against_brute_force(spark, sf_dir):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    want = expected(rows)
    got = queries.op4_document_fingerprints(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == {
        i: (n, hashlib.sha256(t.encode()).hexdigest()) for i, (n, t) in want.items()}
    prints: dict = {}
    texts = dict(rows)
    for r in got:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) == len(prints)
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.95 * len(got)


def test_sparse_ids_and_one_document(spark):
    docs = spark.createDataFrame([(-9_000_000_000, "aaaabbbb"), (5, "ccccdddd"), (7_000_000_000_000, "eeee")],
                                 "doc_id bigint, text string")
    got = {r["doc_id"]: r["edited_text"] for r in G.edited_fingerprints(docs).collect()}
    assert got == {-9_000_000_000: "aaaabbcc", 5: "ccccddee", 7_000_000_000_000: "eeea"}
    alone = G.edited_fingerprints(documents(spark, ["𝄞bcd"])).first()
    assert (alone["n_chars"], alone["edited_text"], alone["near_next"]) == (4, "𝄞bc𝄞", 1.0)


def test_awkward_rows(spark):
    rows = G.edited_fingerprints(awkward(spark)).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_chars"] == 0 and by[1]["edited_text"] == "" and by[None]["near_next"] is None
    assert by[None]["edited_text"] == "a text without "
    assert by[4]["edited_text"] == "one two three one "[:14] + "one "
    assert G.edited_fingerprints(no_documents(spark)).count() == 0
