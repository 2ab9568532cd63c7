"""The additive model: its parts, held-out accuracy, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np

from tallyspark.llm import quality as Q
from tallyspark.llm import queries
from tests.llm.helpers import awkward, documents, no_documents

LABELS = "doc_id bigint, quality int, toxic int"


def test_tables_add_up_to_the_score():
    rng = np.random.default_rng(2)
    x = rng.random((400, 4))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)  # only a pair tells
    model = Q.AdditiveModel(x, y)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.9
    assert (0, 1) in model.pairs
    one = x[7]
    logit = model.base
    for edges, table, v in zip(model.edges, model.tables, one, strict=True):
        logit += table[sum(v > e for e in edges)]
    for (i, j), table in model.pairs.items():
        logit += table[sum(one[i] > e for e in model.coarse[i]), sum(one[j] > e for e in model.coarse[j])]
    assert np.isclose(model.score(x)[7], 1 / (1 + np.exp(-logit)))


def test_quadrants_are_the_best_pair_of_cuts():
    rng = np.random.default_rng(5)
    g, w = rng.normal(size=(5, 4)), rng.random((5, 4)) + 0.1
    values, gain = Q._quadrants(g, w)

    def of(i, j):
        parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)),
                 (slice(i, None), slice(j, None))]
        return sum(g[p].sum() ** 2 / (w[p].sum() + 1) for p in parts)

    # a cut after the last bin is no cut, and may be best
    best = max(of(i, j) for i in range(1, 6) for j in range(1, 5))
    assert np.isclose(gain, best - g.sum() ** 2 / (w.sum() + 1), atol=1e-9)
    assert len(np.unique(values.round(12))) <= 4


def test_leaf_tree_cuts_where_the_sign_changes():
    out = Q._leaf_tree(np.array([5.0, 5, 5, -7, -7, 2]), np.ones(6), 3)
    assert (out[:3] > 0).all() and (out[3:5] < 0).all() and out[5] > 0


def test_held_out_accuracy_and_columns_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op10_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert sum(r["predicted"] == label[r["doc_id"]] for r in tested) >= 0.95 * len(tested)


def test_labels_of_held_out_rows_are_not_learned(spark):
    texts = [("good plain words in a row. " if i % 2 else "$$$ ### !!! ") * (i % 7 + 3) for i in range(80)]
    docs = documents(spark, texts)
    right = [(i, i % 2, 0) for i in range(80)]
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 0) for i, q, _ in right]
    a, b = ({r["doc_id"]: r["score"] for r in Q.score_quality(docs, spark.createDataFrame(x, LABELS)).collect()}
            for x in (right, wrong))
    assert a == b and all((s > 0.5) == (i % 2 == 1) for i, s in a.items())


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 1, 0), (None, 1, 0), (6, None, 0), (2, 0, 1), (999, 1, 1)],
                                   LABELS).selectExpr("*", "1 AS text", "2 AS n")
    rows = Q.score_quality(awkward(spark), labels).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    assert next(r["held_out"] for r in rows if r["doc_id"] is None) is False
    nothing = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in Q.score_quality(awkward(spark), nothing).collect()} == {0.5}
    assert Q.score_quality(no_documents(spark), labels).count() == 0
    assert Q.features(b"") == [0.0] * len(Q.FEATURES) and len(Q.features(b"a\n")) == len(Q.FEATURES)
