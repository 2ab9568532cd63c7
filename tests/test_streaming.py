"""Streaming ingestion against the batch layers."""

from __future__ import annotations

from tallyspark.plans.registry import QUERIES, STREAM_COLUMNS, star_enriched, star_raw


def test_stream_matches_batch_on_what_the_key_determines(spark, sf_dir):
    streamed = QUERIES["q_stream_enriched_orders"](spark, sf_dir)
    batch = star_enriched(spark, sf_dir, STREAM_COLUMNS)
    assert streamed.columns == batch.columns
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_files_with_old_times_are_not_late(spark, tmp_path):
    """Five one-line files, landed over three runs; two were last written days ago."""
    import json
    import os
    import time

    from tallyspark.streaming import ingest

    landing = tmp_path / "landing"
    landing.mkdir()

    def land(number: int, days_old: float = 0) -> None:
        path = landing / f"{number}.json"
        path.write_text(json.dumps({"order_id": number, "line_number": 1}))
        when = time.time() - days_old * 86_400
        os.utime(path, (when, when))

    def run() -> list[int]:
        stream = ingest.raw_order_stream(ingest.read_files(
            spark, str(landing), "order_id bigint, line_number int", max_files_per_trigger=1))
        ingest.run_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        return sorted(r["order_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    land(1)
    assert run() == [1]
    land(2, days_old=3)
    land(3)
    assert run() == [1, 2, 3]
    land(4, days_old=10)
    land(5)
    assert run() == [1, 2, 3, 4, 5]


def test_replayed_batch_overwrites_its_partition(spark, tmp_path):
    from tallyspark.streaming.ingest import write_batches

    path = str(tmp_path / "sink")
    write = write_batches(path)
    df = spark.range(3)
    write(df, 0)
    write(df, 0)  # replay after a failure
    write(df, 1)
    assert spark.read.parquet(path).count() == 6


def test_many_micro_batches_lose_nothing_and_keep_one_copy(spark, sf_dir):
    from tallyspark.plans import layers, star
    from tallyspark.plans.registry import ORDER_SOURCE_SCHEMA
    from tallyspark.session import shared_dir
    from tallyspark.sources import files
    from tallyspark.streaming import ingest

    base = shared_dir(spark, "t-stream")
    # copies of a line land in different files, hence in different micro-batches
    files.write_json(star.order_source(spark, sf_dir).repartition(5), f"{base}/landing")
    raw, lines = star_raw(spark, sf_dir), star_enriched(spark, sf_dir)
    stream = ingest.enriched_order_stream(
        ingest.read_files(spark, f"{base}/landing", ORDER_SOURCE_SCHEMA, max_files_per_trigger=1),
        layers.enriched_customers(raw.customers), layers.enriched_products(raw.products), star.STAR_CATEGORY_CODES, star.STAR_SUB_CATEGORY_CODES)
    ingest.run_available(stream, f"{base}/enriched", f"{base}/checkpoint")
    out = spark.read.parquet(f"{base}/enriched")
    assert out.select("batch_id").distinct().count() == 5
    key = ["order_id", "line_number"]
    assert out.count() == lines.count()
    assert out.groupBy(*key).count().filter("count > 1").isEmpty()


def test_copies_in_later_batches_are_dropped_without_operator_state(spark, tmp_path):
    import json
    import os

    from tallyspark.streaming import ingest

    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    landing.mkdir()
    for number, lines in enumerate([[(1, 1), (1, 1), (None, 1)], [(1, 1), (1, 2), (2, 1)], [(None, 1), (2, 1), (3, None)]]):
        path = landing / f"{number}.json"
        path.write_text("\n".join(json.dumps({"Order ID": o, "Line Number": n, "Ship Date": " 3/2/1995"}) for o, n in lines))
        os.utime(path, (1000 + number, 1000 + number))  # files are read in this order
    keyed = ingest.enriched_order_stream(
        ingest.read_files(spark, str(landing), "`Order ID` bigint, `Line Number` int, `Order Date` string, "
                          "`Ship Date` string, `Customer ID` bigint, `Product ID` string", max_files_per_trigger=1),
        spark.createDataFrame([], "customer_id bigint, customer_name string, country string"),
        spark.createDataFrame([], "product_id string, category string, sub_category string"), {}, {})
    query = ingest.run_available(keyed, str(tmp_path / "out"), str(checkpoint))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 5 and out.select("batch_id").distinct().count() == 3
    assert {(r["order_id"], r["line_number"]) for r in out.collect()} == {(1, 1), (None, 1), (1, 2), (2, 1), (3, None)}
    assert {str(r["ship_date"]) for r in out.collect()} == {"1995-02-03"}
    assert all(not p.stateOperators for p in query.recentProgress) and not (checkpoint / "state").exists()


def _keyed_batches(spark, tmp_path, **how):
    from tallyspark.streaming import ingest

    keyed = ingest.KeyedStream(spark.range(0), "id", "1 hour", **how)
    write = ingest.write_keyed_batches(keyed, str(tmp_path / "out"), str(tmp_path / "times"))

    def batch(number: int, hour: float, *ids: int) -> dict[int, list[int]]:
        rows = spark.createDataFrame([(i, int(hour * 3600)) for i in ids], "id bigint, at bigint")
        write(rows.selectExpr("id", f"timestamp_seconds(at) AS {ingest.EVENT_TIME}"), number)
        found: dict[int, list[int]] = {}
        for r in sorted(spark.read.parquet(str(tmp_path / "out")).collect()):
            found.setdefault(r["batch_id"], []).append(r["id"])
        return found

    return batch


def test_replayed_keyed_batch_keeps_the_same_keys(spark, tmp_path):
    batch = _keyed_batches(spark, tmp_path)
    assert batch(0, 1, 1, 2, 2) == {0: [1, 2]}
    assert batch(1, 1.5, 2, 3) == {0: [1, 2], 1: [3]}
    assert batch(2, 1.6, 3, 1) == {0: [1, 2], 1: [3]}  # copies only
    for number, ids in ((1, (2, 3)), (0, (1, 2, 2))):  # sent again after a failure
        assert batch(number, 1.5, *ids) == {0: [1, 2], 1: [3]}
    assert batch(3, 1.7, 1, 3, 4) == {0: [1, 2], 1: [3], 3: [4]}


def test_keys_are_remembered_for_the_delay_only(spark, tmp_path):
    batch = _keyed_batches(spark, tmp_path)
    batch(0, 1, 1)
    assert batch(1, 2, 1, 2) == {0: [1], 1: [2]}
    assert batch(2, 3.1, 3)[2] == [3]  # the watermark is now past batch 0 and its delay
    assert batch(3, 3.2, 1, 2, 3) == {0: [1], 1: [2], 2: [3], 3: [1]}
    assert sorted(p.name.split("-")[0] for p in (tmp_path / "times").iterdir() if p.name[0] != ".") == ["1", "2", "3"]


def test_keyed_sink_refuses_what_it_cannot_remember(spark, tmp_path):
    import pytest

    from tallyspark.streaming import ingest

    with pytest.raises(ValueError, match="id"):
        _keyed_batches(spark, tmp_path, finish=lambda kept: kept.selectExpr("id AS other"))(0, 1, 1)
    for delay in ("soon", "-1 hour"):
        with pytest.raises(Exception, match="delay|CAST_INVALID|INTERVAL"):
            ingest.write_keyed_batches(ingest.KeyedStream(spark.range(0), "id", delay), "x", "y")
