"""Filter audit against a plain run of every filter in every order."""

from __future__ import annotations

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tallyspark.llm import filter_audit as A
from tallyspark.llm import queries
from tests.llm.helpers import WORD, awkward, no_documents

LABELS = "doc_id bigint, quality int, toxic int"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failed(rows):
    """Failed letters of each (doc_id, text, lang) row."""
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(least.get(text or "", doc), doc)
    found = []
    for doc, text, _ in rows:
        t = text or ""
        words = WORD.findall(t)
        found.append({name for name, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", t)) > 10 * len(t), re.search("[#$%&*|]", t),
            doc is not None and doc > least[t]), strict=True) if bad})
    return found


def plain(rows, labels, orders):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = {}
    fails = failed(rows)
    for part in {lang or "" for *_, lang in rows}:
        own = [(doc, f) for (doc, _, lang), f in zip(rows, fails, strict=True) if (lang or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                all_fail = sum(name in f for _, f in own)
                shapley[name] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), all_fail - len(gone), sum(f == {name} for _, f in own),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for order in orders:
            for step, name in enumerate(order, 1):
                out[part, order, step].append(shapley[name])
    return out


def as_dict(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): [r[c] for c in (*FIGURES, "shapley")] for r in rows}
    assert len(found) == len(rows)
    return found


def test_path_counts_are_those_of_listed_orders():
    for before in ((), (("A", "D"),), (("A", "B"), ("C", "B")), (("B", "A"), ("A", "D"), ("D", "C"))):
        lattice = A.Lattice(list("ABCD"), before)
        legal = ["".join(p) for p in permutations("ABCD") if all(p.index(a) < p.index(b) for a, b in before)]
        assert {order for order, *_ in lattice.orders()} == set(legal)
        taken = {}
        for order, _, state, name in lattice.orders():
            taken[state, name] = taken.get((state, name), 0) + 1
        assert taken == {(s, "ABCD"[i]): lattice.reaching[s] * lattice.leaving[s | 1 << i]
                         for s, i in lattice.edges()}


def test_impossible_and_repeated_filters_are_refused():
    with pytest.raises(ValueError, match="no order"):
        A.Lattice(["A", "B"], (("A", "B"), ("B", "A")))
    with pytest.raises(ValueError, match="different names"):
        A.Lattice(["A", "A"])


def test_query_against_plain_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    want = plain([tuple(r) for r in docs], [tuple(r) for r in labels],
                 ["".join(p) for p in permutations("ABCDE")])
    assert as_dict(queries.op11_filter_audit(spark, sf_dir)) == want


def test_query_against_its_sql(spark, sf_dir, duck):
    rows = duck.execute(queries.ORACLE["op11_filter_audit"])
    names = [c[0] for c in rows.description]
    want = {tuple(r) for r in rows.fetchall()}
    got = queries.op11_filter_audit(spark, sf_dir)
    assert {tuple(r) for r in got.select(*names).collect()} == want
    assert set(names) == set(got.columns)


def test_awkward_rows_and_several_labels(spark):
    docs = awkward(spark)
    labels = [(4, 1, 0), (4, 0, 1), (6, 1, None), (None, 1, 1), (99, 1, 1), (3, None, None)]
    got = as_dict(A.audit(docs, spark.createDataFrame(labels, LABELS), A.text_filters(), "E")
                  .drop("orders_reaching", "orders_leaving"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    assert got == plain(rows, labels, ["".join(p) for p in permutations("ABCDE")])


def test_random_rows_with_forbidden_orders(spark):
    rng = random.Random(4)
    pool = ["#x " * 120, "One TWO", "word " * 130, " ".join(f"w{i}" for i in range(140)), "", None, "a|b"]
    rows = [(rng.choice([None, *range(30)]), rng.choice(pool), rng.choice(["en", "de", None])) for _ in range(120)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 30, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    before = (("E", "A"), ("D", "B"))
    legal = ["".join(p) for p in permutations("ABCDE") if all(p.index(a) < p.index(b) for a, b in before)]
    got = as_dict(A.audit(docs, spark.createDataFrame(labels, LABELS), A.text_filters(), "E", before=before))
    assert got == plain(rows, labels, legal)


def test_other_filters_null_conditions_and_no_copy_filter(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "b", 9)], "doc_id bigint, text string, size int")
    docs = docs.withColumn("lang", F.lit("en"))
    got = A.audit(docs, spark.createDataFrame([], LABELS), {"S": F.col("size") > 6, "T": F.col("text") == "a"})
    assert {(r.filter_order, r.step, r.kept, r.removed) for r in got.collect()} == {
        ("ST", 1, 2, 1), ("ST", 2, 0, 2), ("TS", 1, 1, 2), ("TS", 2, 0, 1)}


def test_empty_table(spark):
    labels = spark.createDataFrame([], LABELS)
    assert A.audit(no_documents(spark), labels, A.text_filters(), "E").count() == 0
