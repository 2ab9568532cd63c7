"""Streaming dedup: reading-time vs order-date event time, side by side.

Lands the order-line source as files, streams them one file per micro-batch
through watermark de-duplication, and counts what survives. The batch layer
keeps one row per (order_id, line_number); the reading-time watermark keeps
them all, while the order-date one drops lines whose order date is behind
the watermark as "late".

usage: python tools/watermark_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tallyspark.operators.transforms import standardize_column_names, trim_string_columns  # noqa: E402,E501
from tallyspark.plans import star  # noqa: E402
from tallyspark.plans.registry import ORDER_SOURCE_SCHEMA, star_enriched  # noqa: E402
from tallyspark.session import build_session, shared_dir  # noqa: E402
from tallyspark.sources import files  # noqa: E402
from tallyspark.streaming import ingest  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    base = shared_dir(spark, "watermark-check")
    files.write_json(star.order_source(spark, sf_dir).repartition(5), f"{base}/landing")
    expected = star_enriched(spark, sf_dir).count()

    def stream():
        return ingest.read_files(spark, f"{base}/landing", ORDER_SOURCE_SCHEMA,
                                 max_files_per_trigger=1)

    reading = ingest.raw_order_stream(stream())
    by_order_date = (trim_string_columns(standardize_column_names(stream()))
                     .withColumn("_t", F.try_to_date("order_date", "d/M/yyyy").cast("timestamp"))
                     .withWatermark("_t", "30 days")
                     .dropDuplicatesWithinWatermark(["order_id", "line_number"]).drop("_t"))
    for label, df in (("reading time", reading), ("order date", by_order_date)):
        out = f"{base}/{label.replace(' ', '_')}"
        ingest.run_available(df, out, f"{out}_checkpoint")
        kept = spark.read.parquet(out).count()
        print(f"{label}: kept {kept} of {expected} order lines")


if __name__ == "__main__":
    main()
