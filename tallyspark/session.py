"""Session construction and shared scratch locations."""

from __future__ import annotations

import contextlib
import itertools
import os
import re
import shlex
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every session of ours carries. AQE re-plans joins and coalesces
# shuffle partitions from runtime sizes; skew-join splits hot partitions.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs an extra shuffle
    # (e.g. when the join's output partitioning would otherwise be reused).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # State of streaming operators lives in RocksDB (spills to local disk, checkpointed
    # to the shared checkpoint folder) instead of the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def _given_at_submit() -> dict[str, str]:
    """Settings that the cluster or ``spark-submit`` gives, without starting
    a JVM (whose memory is one of them)."""
    if SparkContext._active_spark_context is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()  # a JVM is there
        return dict(SparkConf().getAll())
    given = {}
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    with contextlib.suppress(OSError), open(os.path.join(home, "spark-defaults.conf")) as file:
        for line in file:
            parts = line.split("#", 1)[0].split(None, 1)
            if len(parts) == 2:
                given[parts[0]] = parts[1].strip()
    words = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    for word, value in itertools.pairwise(words):
        if word in ("--conf", "-c") and "=" in value:
            given.update([value.split("=", 1)])
        elif word == "--driver-memory":
            given["spark.driver.memory"] = value
        elif word == "--master":
            given["spark.master"] = value
    return given


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tallyspark", extra: dict | None = None) -> SparkSession:
    """A session with our defaults. A default applies only where neither the
    cluster, ``spark-submit`` nor a session that already runs sets the value;
    what the caller passes here always applies."""
    given = set(_given_at_submit())
    running = SparkSession.getActiveSession()
    if running is not None:
        given |= set(running.conf.getAll)
    defaults = {**BASE_CONF, "spark.driver.memory": os.environ.get("TALLYSPARK_DRIVER_MEMORY", "8g")}
    conf = {k: v for k, v in defaults.items() if k not in given}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


BYTES_PER_PARTITION = 128 << 20
MAX_INITIAL_PARTITIONS = 200_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, paths: list[str]) -> int:
    """Sets the number of shuffle partitions that adaptive execution starts
    from (and merges down) to the size of the input, unless the cluster sets
    it: Spark's own 200 would be hundreds of gigabytes each at 100 TB."""
    context = spark.sparkContext
    size = 0
    for path in paths:
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(context._jsc.hadoopConfiguration())
        size += fs.getContentSummary(where).getLength()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(max(least, -(-size // BYTES_PER_PARTITION)), MAX_INITIAL_PARTITIONS)
    if not context.getConf().contains(_INITIAL):
        spark.conf.set(_INITIAL, str(wanted))
    return wanted


def ship_package(spark: SparkSession) -> None:
    """Gives the executors this package (as ``--py-files`` would), once per context."""
    context = spark.sparkContext
    if not getattr(context, "_tallyspark_shipped", False):
        top = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(), "tallyspark_package.zip")
        with zipfile.ZipFile(archive, "w") as file:
            for part in top.rglob("*.py"):
                file.write(part, part.relative_to(top.parent))
        context.addPyFile(str(archive))
        context._tallyspark_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    session on one machine (local runs, tests) gets a folder of its own where
    that is unset; anywhere else it raises, as executors could not read it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the conf is all there is
        context = None
    root = root or (context.getCheckpointDir() if context else None)
    if not root:
        if context is None or not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tallyspark-ckpt-")
    if context is not None and not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{purpose}-{uuid.uuid4().hex}"
