"""Per-stage task time of one registered query, from Spark's event log
(written to a fresh scratch folder; no UI, no server).

usage: python tools/stage_times.py q_name [sf_dir]
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402

from tallyspark.plans.registry import QUERIES  # noqa: E402
from tallyspark.session import build_session  # noqa: E402


def read_events(log_dir: str):
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/local-*"):
        raw = open(path, "rb").read()
        if path.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true",
                                                 "spark.eventLog.dir": log_dir})
    for _ in range(2):  # warm-up, then the measured run
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    names, tasks = {}, collections.defaultdict(list)
    for e in read_events(log_dir):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            names[info["Stage ID"]] = info["Stage Name"]
        if e.get("Event") == "SparkListenerTaskEnd":
            m = e["Task Metrics"]
            tasks[e["Stage ID"]].append((m["Executor Run Time"],
                                         m["Shuffle Write Metrics"]["Shuffle Bytes Written"]))
    ids = sorted(tasks)
    for sid in ids[len(ids) // 2:]:
        runs = [t[0] for t in tasks[sid]]
        print(f"stage {sid:4d} tasks {len(runs):3d} sum {sum(runs):6d}ms max {max(runs):5d}ms "
              f"shuffle {sum(t[1] for t in tasks[sid]) // 1024:7d}KB  {names.get(sid, '')[:60]}")


if __name__ == "__main__":
    main()
