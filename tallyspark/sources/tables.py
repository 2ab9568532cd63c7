"""Idempotent table sinks.

A table is always replaced whole (``overwrite``), so re-running a layer
gives the same table. Row counts are observed while the rows are written
(``DataFrame.observe``), not by a second job over the source; the read-back
check counts the stored table, which parquet answers from file footers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.sources import snapshots


def create_database(spark: SparkSession, name: str, location: str | None = None,
                    use: bool = False) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (at a shared ``location``); with
    ``use=True`` it also becomes the session's current database."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    if use:
        spark.catalog.setCurrentDatabase(name)
    return name


@contextmanager
def current_database(spark: SparkSession, name: str, location: str | None = None) -> Iterator[str]:
    """Inside, ``name`` (created if missing) is the session's current database;
    afterwards the one before is again."""
    before = spark.catalog.currentDatabase()
    try:
        yield create_database(spark, name, location, use=True)
    finally:
        spark.catalog.setCurrentDatabase(before)


def write_table(df: DataFrame, name: str, *, path: str | None = None, fmt: str | None = None,
                partition_by: Sequence[str] | None = None) -> int:
    """Replace table ``name`` with ``df``; returns the rows written.

    ``path`` makes it an external table at that (shared) location; ``fmt``
    defaults to the session's ``spark.sql.sources.default``. A partitioned
    table is replaced whole too, whatever the session's overwrite mode."""
    obs = Observation(f"write_{name.replace('.', '_')}")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static")
    if fmt:
        writer = writer.format(fmt)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return int(obs.get["rows"])


def write_bucketed(df: DataFrame, name: str, *, path: str, keys: Sequence[str], buckets: int) -> int:
    """Replaces table ``name`` with the rows of ``df`` dealt into ``buckets`` by
    ``keys`` and sorted by them; returns the rows written. A join or grouping
    on the keys (or on more columns) then shuffles neither this table nor one
    dealt alike. One task writes a bucket and one reads it, so choose enough
    buckets for parts of 128 to 512 MB, and keys of which none is hot."""
    obs = Observation(f"bucketed_{name.replace('.', '_')}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).repartition(buckets, *keys)
     .write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return int(obs.get["rows"])


def write_tables(tables: Mapping[str, DataFrame], *, location_root: str | None = None,
                 fmt: str | None = None) -> dict[str, int]:
    """Write each table (callers run their quality gates first, so a failed
    gate leaves every table as it was). Errors name the table and re-raise."""
    written = {}
    for name, df in tables.items():
        path = f"{location_root.rstrip('/')}/{name.split('.')[-1]}" if location_root else None
        try:
            written[name] = write_table(df, name, path=path, fmt=fmt)
        except Exception as exc:
            raise RuntimeError(f"Failed to write {name}: {exc}") from exc
    return written


def read_back_counts(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """(table, rows) for each stored table, as one DataFrame."""
    frames = [spark.table(n).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(n).alias("table"), "rows") for n in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def publish_tables(spark: SparkSession, tables: Mapping[str, DataFrame], location_root: str,
                   gate: Callable[[dict[str, DataFrame]], None] | None = None,
                   fmt: str = "parquet",
                   observe: Mapping[str, Mapping[str, Column]] | None = None,
                   observed: dict | None = None, keep_versions: int = 2) -> dict[str, int]:
    """Write, check, then publish: each layer is computed once.

    1. every table is written once to a new version folder
       ``<root>/<table>/v-<run>``; its row count, and any aggregate in
       ``observe[table]`` (name → column), is computed during that write
       (``DataFrame.observe``) and put in ``observed[table]`` — no second
       pass over the data;
    2. ``gate`` gets the *stored* versions (a cheap columnar re-read) and can
       use ``observed``; it raises to stop, and nothing has been published
       yet, so the current tables stay as they were;
    3. all tables are published at once, as the next snapshot of the root
       (``sources.snapshots``): who reads ``snapshots.latest`` sees all of
       them or none, and of two jobs that replace a table one fails;
    4. each table name is pointed at its new folder. That is a catalog
       operation per table; after a failure between two of them
       ``point_names`` mends the names from the snapshot;
    5. of the root's snapshots, the newest ``keep_versions`` stay (readers of
       the one before can finish); folders that only older ones name are
       deleted.

    A re-run writes a new version and re-points the name, so the result is
    the same; a run that dies mid-way leaves an unpublished folder behind,
    never a half-written table.
    """
    run = uuid.uuid4().hex[:12]
    base = snapshots.latest(spark, location_root)
    observed = {} if observed is None else observed
    paths, written = {}, {}
    for name, df in tables.items():
        path = f"{location_root.rstrip('/')}/{name.replace('.', '/')}/v-{run}"
        obs = Observation(f"publish_{name.replace('.', '_')}_{run}")
        extra = [c.alias(m) for m, c in ((observe or {}).get(name) or {}).items()]
        df.observe(obs, F.count(F.lit(1)).alias("rows"), *extra).write.format(fmt).save(path)
        observed[name] = dict(obs.get)
        paths[name], written[name] = path, int(observed[name]["rows"])
    # the schema is known: re-reading and registering need no inference pass
    staged = {name: spark.read.schema(tables[name].schema).format(fmt).load(path)
              for name, path in paths.items()}
    if gate is not None:
        gate(staged)
    made = snapshots.commit(spark, base, {
        name: snapshots.TableVersion.of(tables[name], path, written[name]) for name, path in paths.items()})
    point_names(spark, made, list(paths), fmt)
    snapshots.expire(spark, location_root, keep_versions)
    return written


def point_names(spark: SparkSession, snapshot: snapshots.Snapshot, names: Sequence[str] | None = None,
                fmt: str = "parquet") -> None:
    """Points catalog names (default: all of the snapshot that have one
    folder) at the snapshot's folders; can be repeated."""
    for name, version in snapshot.tables.items():
        if list(version.folders) == [""] and (names is None or name in names):
            _point(spark, name, version.folders[""], fmt, StructType.fromJson(json.loads(version.schema)))


def _point(spark: SparkSession, name: str, path: str, fmt: str, schema) -> None:
    """Make table ``name`` read ``path``. An existing table with the same
    columns is re-pointed in one catalog operation (readers never find it
    missing); a new table, or one whose columns changed, is (re)created."""
    if spark.catalog.tableExists(name):
        current = spark.table(name).schema
        same = [(f.name, f.dataType) for f in current] == [(f.name, f.dataType) for f in schema]
        if same:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {name}")
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source=fmt, schema=schema)
