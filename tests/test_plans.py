"""Physical-plan properties that matter at scale: pruning, no Python in the
hot path, partial aggregation, shuffle reuse, skew handling."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from tallyspark.operators.enrich import Dimension, enrich
from tallyspark.plans.registry import QUERIES

IO_QUERIES = {"q_csv_roundtrip", "q_json_roundtrip", "q_json_array", "q_reconcile", "q_overwrite_idempotent", "q_raw_layer"}


@contextlib.contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - IO_QUERIES))
def test_no_python_evaluation(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(QUERIES["q_profit_by_year"](spark, sf_dir))
    lineitem_schema = [ln for ln in plan.splitlines() if "lineitem" in ln][0]
    for unused in ("l_tax", "l_returnflag", "l_linestatus", "l_suppkey"):
        assert unused not in lineitem_schema


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def joins_and_exchanges(spark, df) -> tuple[int, int]:
    plan = plan_of(df)
    return plan.count("SortMergeJoin"), plan.count("Exchange hashpartitioning")


@pytest.mark.parametrize("name,most_joins", [
    ("q_duplicate_summary", 0), ("q_round_money", 0), ("q_parse_date", 1), ("q_profit_by_year", 1),
    ("q_distinct_domain", 2), ("q_profit_by_year_category", 3), ("q_profit_by_customer", 4),
])
def test_only_joins_that_bring_a_column(spark, sf_dir, name, most_joins):
    with conf(spark, **NO_BROADCAST):
        joins, _ = joins_and_exchanges(spark, QUERIES[name](spark, sf_dir))
    assert joins <= most_joins


def test_copies_go_before_the_joins(spark, sf_dir):
    with conf(spark, **NO_BROADCAST):
        plan = plan_of(QUERIES["q_dedup_keep_one"](spark, sf_dir))
    # parents are printed above children: no join below the window, and the
    # limit of one row per key runs on both sides of its exchange
    assert "Join" in plan and "Join" not in plan[plan.index("Window [row_number"):]
    assert plan.count("WindowGroupLimit") == 2


def test_reconcile_plans_enrichment_once(spark, sf_dir):
    plan = plan_of(QUERIES["q_reconcile"](spark, sf_dir))
    assert "lineitem" not in plan  # both totals read the stored enriched table


def test_reports_aggregate_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["q_profit_summary"](spark, sf_dir))
    assert "partial_sum" in plan and "partial_count" in plan


def test_hot_key_join_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    n = 120_000
    with conf(spark, **settings):
        # one customer holds a third of the fact rows
        fact = spark.range(n).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
            .alias("customer_id"))
        dim = spark.range(500).select(F.col("id").alias("customer_id"),
                                      F.col("id").cast("string").alias("name"))
        out = enrich(fact, [Dimension(dim, "customer_id", ("name",))])
        res = out.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
        rows = {r["name"]: r["n"] for r in res.collect()}
        plan = plan_of(res)
    assert sum(rows.values()) == n
    assert rows["7"] == sum(1 for i in range(n) if i % 3 == 0 or i % 500 == 7)
    assert "SortMergeJoin(skew=true)" in plan


def test_declared_unique_dimensions_let_unused_joins_go(spark, sf_dir):
    from tallyspark.operators import aggregate as agg
    from tallyspark.plans import layers, star

    specs = dict(layers.DEFAULT_SPECS)
    specs["customers"] = layers.SourceSpec("customer_id", declare_unique=True)
    specs["products"] = layers.SourceSpec("product_id", declare_unique=True)
    raw = layers.raw_layer(star.sources(spark, sf_dir), specs)
    enriched = layers.enriched_layer(raw, star.STAR_CATEGORY_CODES,
                                     star.STAR_SUB_CATEGORY_CODES).orders

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert joins(agg.profit_by_year(enriched)) == 2           # the source's own; no dimension column used
    assert joins(agg.profit_by_year_category(enriched)) == 3  # product join stays
    assert joins(enriched) == 6                               # everything is needed
    expected = QUERIES["q_profit_by_year"](spark, sf_dir)
    assert agg.profit_by_year(enriched).collect() == expected.collect()


def test_default_dimensions_keep_exceptall_working(spark, sf_dir):
    from tallyspark.plans.registry import star_enriched

    batch = star_enriched(spark, sf_dir)
    keys = batch.select("order_id", "line_number").limit(50)
    semi = batch.join(keys, ["order_id", "line_number"], "left_semi")
    assert semi.exceptAll(semi).isEmpty()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - IO_QUERIES - {"q_stream_enriched_orders"}))
def test_whole_tables_no_row_caps(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    has_limit = "GlobalLimit" in plan or "LocalLimit" in plan
    assert has_limit == (name == "q_top_n_groups")
