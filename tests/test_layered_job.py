"""The layered job: gates, table writes, next layer from stored tables."""

from __future__ import annotations

import uuid

from pyspark.testing import assertDataFrameEqual

from tallyspark.plans import job
from tallyspark.plans.registry import QUERIES


def test_layers_written_and_reports_match_queries(spark, sf_dir):
    suffix = "_" + uuid.uuid4().hex[:8]
    run = job.run(spark, sf_dir, suffix=suffix)
    names = {n.removesuffix(suffix) for n in run.written}
    assert names == {"raw_customers", "raw_products", "raw_orders", "enriched_customers",
                     "enriched_products", "enriched_orders", "agg_profit_summary"}
    counts = {n.removesuffix(suffix): c for n, c in run.written.items()}
    assert counts["raw_orders"] == counts["enriched_orders"]
    assert counts["raw_customers"] == counts["enriched_customers"]
    stored = spark.table(f"enriched_orders{suffix}")
    assert stored.count() == counts["enriched_orders"]
    assertDataFrameEqual(stored, QUERIES["q_enrich_orders"](spark, sf_dir))
    assertDataFrameEqual(spark.table(f"agg_profit_summary{suffix}"),
                         QUERIES["q_profit_summary"](spark, sf_dir))
    for name, df in run.reports.items():
        assertDataFrameEqual(df, QUERIES[f"q_{name}"](spark, sf_dir), checkRowOrder=True)


def test_rerun_gives_the_same_tables(spark, sf_dir):
    suffix = "_" + uuid.uuid4().hex[:8]
    first = job.run(spark, sf_dir, suffix=suffix)
    before = spark.table(f"agg_profit_summary{suffix}").collect()
    second = job.run(spark, sf_dir, location=first.location, suffix=suffix)
    assert first.written == second.written
    assertDataFrameEqual(spark.table(f"agg_profit_summary{suffix}"), before)


def test_command_line_over_the_driver_tables(spark, sf_dir, capsys):
    import json

    from tallyspark.__main__ import main

    db = "star_" + uuid.uuid4().hex[:8]
    main(["star", "--sf-dir", sf_dir, "--database", db, "--show", "2"])
    out = capsys.readouterr().out
    written = json.loads(out.splitlines()[0])["written"]
    assert written[f"{db}.raw_orders"] == written[f"{db}.enriched_orders"]
    assertDataFrameEqual(spark.table(f"{db}.agg_profit_summary"),
                         QUERIES["q_profit_summary"](spark, sf_dir))


def test_without_key_verification_the_gates_read_no_large_table(spark, sf_dir):
    suffix = "_" + uuid.uuid4().hex[:8]
    fast = job.run(spark, sf_dir, suffix=suffix, verify_keys=False)
    assertDataFrameEqual(spark.table(f"agg_profit_summary{suffix}"),
                         QUERIES["q_profit_summary"](spark, sf_dir))
    assert {n.removesuffix(suffix): c for n, c in fast.written.items()}["raw_orders"] == \
        QUERIES["q_dedup_keep_one"](spark, sf_dir).count()
