"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no driver collect),
once to warm up, then ``$BENCH_REPEATS`` times; the median is reported. The
layered job (write raw → enriched → aggregate tables, then the four
reports over the stored table) is timed as ``layered_job``.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans import job  # noqa: E402
from tallyspark.plans.registry import QUERIES  # noqa: E402
from tallyspark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def sf_of(path: str) -> float | str:
    tail = os.path.basename(path.rstrip("/"))
    try:
        return float(tail.removeprefix("sf"))
    except ValueError:
        return tail


def main() -> None:
    spark = build_session(f"local[{CPUS}]", CPUS * 2,
                          extra={"spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    names = [q for q in ONLY if q in QUERIES] if ONLY else sorted(QUERIES)
    results: dict[str, float] = {}
    errors: dict[str, str] = {}

    def measure(name: str, fn) -> None:
        try:
            fn()
            samples = [timed(fn) for _ in range(REPEATS)]
        except Exception as exc:  # noqa: BLE001 - report it, keep benchmarking the rest
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            print(f"# {name}: FAILED {errors[name]}", file=sys.stderr)
            return
        results[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {results[name]}s", file=sys.stderr)

    for name in names:
        build = QUERIES[name]
        measure(name, lambda: run_noop(build(spark, SF_DIR)))

    if not ONLY or "layered_job" in ONLY:
        def layered():
            run = job.run(spark, SF_DIR, suffix="_" + uuid.uuid4().hex[:8])
            for df in run.reports.values():
                run_noop(df)
        measure("layered_job", layered)

    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": sf_of(SF_DIR),
        "cpus": CPUS,
        "repeats": REPEATS,
        "spark": spark.version,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
