"""Rows set aside, and layers stored by the key they are joined on."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tallyspark.operators import aggregate as agg
from tallyspark.operators import quality as qa
from tallyspark.operators import quarantine as Q
from tallyspark.operators.enrich import Dimension, enrich
from tallyspark.session import shared_dir
from tallyspark.sources import tables


def rules():
    return {"low": F.col("n") < 10, "odd": F.col("n") % 2 == 1, "none": F.col("n").isNull()}


def test_good_and_bad_rows_and_counts_by_rule(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, *range(30)])) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, n int")
    split = Q.write_split(df, rules(), shared_dir(spark, "t-quarantine"))
    fails = lambda n: [name for name, bad in (
        ("low", n is not None and n < 10), ("odd", n is not None and n % 2 == 1), ("none", n is None)) if bad]
    assert {(r["id"], tuple(r["failed_rules"])) for r in split.bad.collect()} == {
        (i, tuple(fails(n))) for i, n in rows if fails(n)}
    assert split.good.columns == df.columns
    assert {tuple(r) for r in split.good.collect()} == {(i, n) for i, n in rows if not fails(n)}
    assert (split.rows, split.quarantined) == (300, split.bad.count())
    want = qa.row_rules(df, "t", rules()).where("rule <> 'not_empty'")
    assertDataFrameEqual(split.rules("t"), want)


def test_all_good_all_bad_and_empty(spark):
    write = lambda df, rules: Q.write_split(df, rules, shared_dir(spark, "t-quarantine"))
    df = spark.range(5).withColumn("n", F.col("id").cast("int"))
    assert (write(df, {"x": F.lit(False)}).good.count(), write(df, {"x": F.lit(False)}).bad.count()) == (5, 0)
    assert (write(df, {"x": F.lit(True)}).good.count(), write(df, {"x": F.lit(True)}).bad.count()) == (0, 5)
    none = write(df.limit(0), rules())
    assert (none.rows, none.good.count(), none.bad.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="rules"):
        Q.failure_mask({})
    with pytest.raises(ValueError, match="in the way"):
        write(df.withColumn("_failed", F.lit(1)), rules())
    many = {f"r{i}": F.col("id") == i for i in range(62)}
    assert write(spark.range(62), many).failed == dict.fromkeys(many, 1)


def test_stored_by_key_joins_and_customer_reports_shuffle_no_facts(spark):
    mark = uuid.uuid4().hex[:10]
    facts = spark.range(4000).selectExpr("id", "id % 97 AS customer_id", "id / 7 AS profit",
                                         "make_date(2015 + id % 3, 1, 1) AS order_date")
    people = spark.range(90).selectExpr("id AS customer_id", "concat('n', id % 40) AS customer_name")
    root = shared_dir(spark, "t-bucketed")
    for name, df in ((f"facts_{mark}", facts), (f"people_{mark}", people)):
        assert tables.write_bucketed(df, name, path=f"{root}/{name}", keys=["customer_id"], buckets=6) == df.count()
    stored, dimension = spark.table(f"facts_{mark}"), spark.table(f"people_{mark}")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = enrich(stored, [Dimension(dimension, "customer_id", ("customer_name",))])
        for report in (agg.profit_by_customer, agg.profit_by_customer_year):
            plan = report(wide)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "hashpartitioning" not in plan
            unbucketed = report(enrich(facts, [Dimension(people, "customer_id", ("customer_name",))]))
            assert "hashpartitioning" in unbucketed._jdf.queryExecution().executedPlan().toString()
            assertDataFrameEqual(report(wide), unbucketed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
