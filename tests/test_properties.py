"""Invariants on generated data, checked against brute force in Python.

Many generated datasets are tagged with a dataset id and processed in one
Spark job (the id is part of every key), which keeps the run short."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import aggregate as agg
from tallyspark.operators import quality as qa
from tallyspark.operators.enrich import Dimension, enrich
from tallyspark.operators.keyed import duplicate_summary, remove_duplicate_keys

SCHEMA = "ds int, k string, price double, note string"


def generated(seed: int, datasets: int = 40):
    rnd = random.Random(seed)
    rows = []
    for ds in range(datasets):
        keys = [f"k{i}" for i in range(rnd.randint(1, 6))] + [None]
        for _ in range(rnd.randint(0, 30)):
            rows.append((ds, rnd.choice(keys), rnd.choice([None, round(rnd.uniform(-50, 50), 4)]),
                         rnd.choice(["a", "b", None, "a b"])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return generated(7)


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def sort_key(row):
    # ascending, NULLs first, as the operator orders
    return tuple((v is not None, v if v is not None else 0) for v in row)


def test_dedup_keeps_the_first_row_of_every_key(df, rows):
    out = remove_duplicate_keys(df, ["ds", "k"], order_by=["price"])
    got = sorted((tuple(r) for r in out.collect()), key=sort_key)
    best = {}
    for r in rows:
        key = (r[0], r[1])
        cand = (r[2], r[3])
        if key not in best or sort_key(cand) < sort_key(best[key]):
            best[key] = cand
    want = sorted(((k[0], k[1], *v) for k, v in best.items()), key=sort_key)
    assert got == want


def test_dedup_is_idempotent_and_partition_independent(spark, df):
    once = remove_duplicate_keys(df, ["ds", "k"])
    again = remove_duplicate_keys(once, ["ds", "k"])
    other = remove_duplicate_keys(df.repartition(2, "note"), ["ds", "k"])
    a = sorted(map(tuple, once.collect()), key=sort_key)
    assert a == sorted(map(tuple, again.collect()), key=sort_key)
    assert a == sorted(map(tuple, other.collect()), key=sort_key)


def test_duplicate_summary_matches_counting(df, rows):
    got = {(r["ds"], r["k"]): r["count"] for r in duplicate_summary(df, ["ds", "k"]).collect()}
    counts = Counter((r[0], r[1]) for r in rows)
    assert got == {k: n for k, n in counts.items() if n > 1}


def test_group_totals_add_up_to_the_table_total(df, rows):
    with_year = df.select(F.col("ds"), F.col("k"), F.col("price").alias("profit"))
    groups = agg.summarize(with_year, ["ds", "k"], {"total": agg.money_total("profit")})
    per_ds = defaultdict(Decimal)
    for r in groups.collect():
        if r["total"] is not None:
            per_ds[r["ds"]] += Decimal(str(r["total"]))
    exact = defaultdict(Decimal)
    for r in rows:
        if r[2] is not None:
            exact[r[0]] += Decimal(str(r[2]))
    # each group is rounded once, so the sum of groups is within half a cent per group
    n_groups = Counter(r[0] for r in {(r[0], r[1]) for r in rows})
    for ds, total in exact.items():
        assert abs(per_ds[ds] - total) <= Decimal("0.005") * n_groups[ds]
    # and one total over the table is the exactly rounded sum
    one = with_year.groupBy("ds").agg(agg.money_total("profit").alias("t")).collect()
    for r in one:
        if r["t"] is not None:
            assert Decimal(str(r["t"])) == exact[r["ds"]].quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_left_join_keeps_rows_with_unique_dimension_keys(spark, df, rows):
    dim = spark.createDataFrame([(f"k{i}", f"name{i}") for i in range(3)], "k string, name string")
    out = enrich(df, [Dimension(dim, "k", ("name",))])
    assert out.count() == len(rows)
    rules = {r["rule"]: r for r in qa.row_count_match(df, out, "x").collect()}
    assert rules["row_count_match"]["passed"]


def test_row_count_rule_catches_dimension_fan_out(spark, df, rows):
    dim = spark.createDataFrame([("k0", "a"), ("k0", "b")], "k string, name string")
    out = enrich(df, [Dimension(dim, "k", ("name",))])
    failed = qa.row_count_match(df, out, "x").first()["failed"]
    assert failed == sum(1 for r in rows if r[1] == "k0")
    assert not qa.row_rules(dim, "dim", key="k").filter("rule = 'unique_key'").first()["passed"]


def test_row_rules_count_like_python(df, rows):
    got = {r["rule"]: (r["checked"], r["failed"]) for r in qa.row_rules(
        df, "t", {"no_price": F.col("price").isNull(), "neg": F.col("price") < 0},
        key=["ds", "k"]).collect()}
    keys = Counter((r[0], r[1]) for r in rows)
    assert got["not_empty"] == (len(rows), 0)
    assert got["unique_key"] == (len(keys), sum(1 for n in keys.values() if n > 1))
    assert got["null_key"] == (len(rows), sum(1 for r in rows if r[1] is None))
    assert got["no_price"] == (len(rows), sum(1 for r in rows if r[2] is None))
    assert got["neg"] == (len(rows), sum(1 for r in rows if r[2] is not None and r[2] < 0))


def test_code_decoding_matches_a_dictionary_lookup(spark):
    from tallyspark.functions.codes import REFERENCE_CATEGORY_CODES as cats
    from tallyspark.functions.codes import REFERENCE_SUB_CATEGORY_CODES as subs
    from tallyspark.operators.transforms import derive_category_from_product_id

    rnd = random.Random(3)
    pool_c = list(cats) + ["XYZ", "fur", ""]
    pool_s = list(subs) + ["ZZ", "ch", ""]
    rows = []
    for i in range(400):
        pid = f"{rnd.choice(pool_c)}-{rnd.choice(pool_s)}-{i}" if i % 7 else None
        rows.append((i, pid, rnd.choice([None, "Given"]), rnd.choice([None, "GivenSub"])))
    df = spark.createDataFrame(rows, "i int, product_id string, category string, sub_category string")
    got = {r["i"]: (r["category"], r["sub_category"])
           for r in derive_category_from_product_id(df).collect()}
    for i, pid, cat, sub in rows:
        want_c = cat if cat is not None else (cats.get(pid[0:3]) if pid else None)
        want_s = sub if sub is not None else (subs.get(pid[4:6]) if pid else None)
        assert got[i] == (want_c, want_s), (pid, cat, sub)
