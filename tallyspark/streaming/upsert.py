"""A stream that keeps, of each key, the row the batch rule keeps.

``ingest`` lets the first copy of a line pass. Here every micro-batch is merged
into a stored table by the rule of the batch layer: its rows and the stored rows
of the parts they fall in go through the same de-duplication, and the parts are
replaced. The least row of a total order does not depend on how rows are grouped
into batches, so the table is what the batch layer makes of everything landed so
far, in all columns, however late a copy comes. What has been seen lives in the
table, not in operator state: nothing expires, and no row passes through Python.

A micro-batch is one snapshot (``sources.snapshots``), which also holds the
number of the last batch merged; a batch that is replayed after a failure is
recognised and skipped, so each counts once. ``part`` should put keys that
arrive together in one part: only parts with new rows are read and written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.transforms import standardize_column_names, trim_string_columns
from tallyspark.plans.layers import SourceSpec
from tallyspark.sources import snapshots
from tallyspark.sources.snapshots import TableVersion

PART = "_part"


def progress_name(table: str, stream: str) -> str:
    return f"{table}.{stream}.batches"


def upsert_batches(root: str, table: str, spec: SourceSpec, part: Column, stream: str = "stream",
                   keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for source rows; ``part`` is over the standard
    column names, and ``stream`` names the writer whose batch numbers are kept."""
    progress = progress_name(table, stream)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        base = snapshots.latest(spark, root)
        if progress in base.tables and base.tables[progress].rows >= batch_id:
            return  # merged before the failure that made Spark send it again
        rows = trim_string_columns(standardize_column_names(batch)).withColumn(PART, part)
        sizes = snapshots.part_rows(rows, PART)
        parts = list(sizes)
        if None in parts:
            raise ValueError("some rows have no part: their key is NULL")
        if not parts:
            return
        carried = {}
        if table in base.tables:
            carried = base.tables[table].folders
            stored = base.table(spark, table, parts).withColumn(PART, part)
            sizes += snapshots.part_rows(stored, PART)
            rows = rows.unionByName(stored)
        new = snapshots.stage_first(spark, root, table, rows, PART, sizes, spec.key, spec.ordering())
        snapshots.commit(spark, base, {
            table: TableVersion(new.schema, {**carried, **new.folders}),
            progress: TableVersion(new.schema, {}, batch_id)})
        snapshots.expire(spark, root, keep)

    return write


def run_available(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Merges everything available now, then stops."""
    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return snapshots.latest(spark, root).table(spark, table)
