"""Command line: run the layered job and print the written tables and reports.

  python -m tallyspark files --customers Customer.csv --products Products.csv \\
      --orders Orders.json [--database sales] [--location <shared folder>]
  python -m tallyspark star --sf-dir /root/testdata/sf0.01 [--database sales]

``--location`` defaults to a new folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json

from tallyspark.plans import job, landing, layers
from tallyspark.session import build_session, size_shuffles


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tallyspark")
    sub = ap.add_subparsers(dest="mode", required=True)
    f = sub.add_parser("files", help="the three source files")
    f.add_argument("--customers", required=True)
    f.add_argument("--products", required=True)
    f.add_argument("--orders", required=True)
    f.add_argument("--orders-schema", default=None, help="DDL schema of the orders JSON")
    f.add_argument("--ndjson", action="store_true", help="orders are line-delimited JSON")
    s = sub.add_parser("star", help="the sales star over the driver tables")
    s.add_argument("--sf-dir", required=True)
    for p in (f, s):
        p.add_argument("--database", default=None)
        p.add_argument("--location", default=None)
        p.add_argument("--master", default=None)
        p.add_argument("--show", type=int, default=10, help="rows of each report to print")
        p.add_argument("--no-verify-keys", action="store_true",
                       help="skip re-checking raw key uniqueness (guaranteed by the dedup)")
        p.add_argument("--max-share", type=float, default=None,
                       help="share of dates, prices or records that may fail to parse (default 0.05)")
    args = ap.parse_args(argv)
    shares = {} if args.max_share is None else dict.fromkeys(job.MAX_SHARES, args.max_share)

    spark = build_session(args.master)
    if args.mode == "files":
        size_shuffles(spark, [args.customers, args.products, args.orders])
        src = landing.reference_files(spark, args.customers, args.products, args.orders,
                                      args.orders_schema, orders_multi_line=not args.ndjson)
        run = job.run_layers(spark, src, layers.REFERENCE_CONFIG, args.location,
                             database=args.database, verify_keys=not args.no_verify_keys, max_shares=shares)
    else:
        size_shuffles(spark, [f"{args.sf_dir}/lineitem.parquet", f"{args.sf_dir}/orders.parquet"])
        run = job.run(spark, args.sf_dir, args.location, database=args.database,
                      verify_keys=not args.no_verify_keys, max_shares=shares)
    print(json.dumps({"location": run.location, "written": run.written,
                      "duplicates_removed": run.duplicates_removed,
                      "reported": run.reported}))
    for name, df in run.reports.items():
        print(f"-- {name}")
        df.show(args.show, truncate=False)


if __name__ == "__main__":
    main()
