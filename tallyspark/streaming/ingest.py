"""Order lines as a stream.

Our extension (the batch pipeline has no streaming counterpart): the same
row-local operators — renames, trimming, date parsing, rounding, code
decoding — are projections, so they apply to a streaming DataFrame as is.
What changes is the keyed work:

* de-duplication is on the business key, with the time a line is read
  (``current_timestamp`` of its micro-batch) as event time. Neither the order
  date nor a file's own time moves forward with arrival (files are copied with
  old times, and back-filled), so a watermark on them would drop lines as late;
  the reading time cannot be late. Copies read within ``delay`` of each other
  collapse to one, the first to arrive (the batch layer keeps the lowest price;
  see ``layers.DEFAULT_SPECS``). The sink does it (``write_keyed_batches``): one
  row per key of the micro-batch, less the keys that the batches of the last
  ``delay`` have stored. Operator state would hold every key in the executors'
  heap, or take a RocksDB request per row. What is read back is bounded by the
  delay, and read by every micro-batch: a few large ones suit it best.
* enrichment is a left join of each micro-batch against the customer and product
  tables: pass stored ones, as a lazy plan would run again in every micro-batch.
* the sink is ``foreachBatch``: each micro-batch replaces its own
  ``batch_id`` partition, so a batch replayed after a failure overwrites
  rather than duplicates, and the checkpoint lives under the shared
  ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.operators.keyed import KeySpec, key_list, remove_duplicate_keys
from tallyspark.operators.transforms import standardize_column_names, trim_string_columns
from tallyspark.plans import layers
from tallyspark.sources import snapshots

EVENT_TIME = "_event_time"


@dataclass(frozen=True)
class KeyedStream:
    """Rows with their time of reading (``EVENT_TIME``), of which the sink keeps
    one per key within ``delay``. What it keeps goes through ``finish``, which
    leaves the key as it is."""

    rows: DataFrame
    key: KeySpec
    delay: str
    finish: Callable[[DataFrame], DataFrame] = lambda kept: kept


def read_files(spark: SparkSession, path: str, schema: str, fmt: str = "json",
               max_files_per_trigger: int | None = None, max_file_age: str = "36500d") -> DataFrame:
    """Spark forgets, and skips, files this much older than the newest it has
    seen (its own default is a week), so a shorter age bounds the list of files
    it remembers but must exceed how late a file can land."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def raw_order_stream(stream: DataFrame, key: KeySpec = ("order_id", "line_number"),
                     delay: str = "1 day") -> KeyedStream:
    """Raw-layer treatment of a stream of source order lines; the time of
    reading is the event time."""
    landed = stream.withColumn(EVENT_TIME, F.current_timestamp())
    return KeyedStream(trim_string_columns(standardize_column_names(landed)), key, delay)


def enriched_order_stream(stream: DataFrame, customers: DataFrame, products: DataFrame,
                          category_codes: Mapping[str, str],
                          sub_category_codes: Mapping[str, str],
                          delay: str = "1 day") -> KeyedStream:
    raw = raw_order_stream(stream, delay=delay)
    # typed before the sink shuffles them: dates are shorter than their text
    return replace(raw, rows=layers.typed_orders(raw.rows), finish=lambda typed: layers.widened_orders(
        typed, customers, products, category_codes, sub_category_codes))


def write_batches(path: str):
    """``foreachBatch`` sink: micro-batch ``n`` replaces partition
    ``batch_id=n`` of a parquet table at ``path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(path))
    return write


def _micros(spark: SparkSession, delay: str) -> int:
    """Length of a delay, as watermarks have it (``1 day``), in microseconds."""
    start = F.lit("2000-01-01").cast("timestamp")
    later = F.unix_micros(start + F.lit(delay).cast("interval")) - F.unix_micros(start)
    micros = spark.range(1).select(later).first()[0]
    if micros is None or micros < 0:
        raise ValueError(f"Not a delay: {delay!r}")
    return micros


def write_keyed_batches(keyed: KeyedStream, path: str, times: str):
    """``write_batches`` of one row per key that no earlier micro-batch within the
    delay has stored. The folder ``times`` has an empty file for each of those,
    named after its number and time of reading.

    As a watermark has it, a batch counts until one more than twice the delay
    later has been read. A batch that is replayed looks at those before it only,
    so it keeps the same keys again. NULL keys are equal."""
    keys, write = key_list(keyed.key), write_batches(path)
    spark = keyed.rows.sparkSession
    delay = _micros(spark, keyed.delay)

    def write_new(batch: DataFrame, batch_id: int) -> None:
        read_at = batch.select(F.unix_micros(EVENT_TIME)).first()
        if read_at is None:
            return
        noted = {int(n): int(at) for n, at in (x.split("-") for x in snapshots.list_names(spark, times))}
        earlier = {n: at for n, at in noted.items() if n < batch_id}
        past = {n for n, at in earlier.items() if at + 2 * delay <= max(earlier.values())}
        stored = set(snapshots.list_names(spark, path)) if earlier else set()
        folders = [f"{path}/batch_id={n}" for n in sorted(earlier.keys() - past) if f"batch_id={n}" in stored]
        new = remove_duplicate_keys(batch.drop(EVENT_TIME), keys)
        if folders:
            seen = batch.sparkSession.read.schema(new.select(*keys).schema).parquet(*folders)
            new = new.join(seen, [new[k].eqNullSafe(seen[k]) for k in keys], "left_anti")
        out = keyed.finish(new)
        if missing := [k for k in keys if k not in out.columns]:
            raise ValueError(f"Key columns not kept: {missing}")
        write(out, batch_id)
        snapshots.touch(spark, f"{times}/{batch_id}-{read_at[0]}")
        for n in past:
            snapshots.delete(spark, f"{times}/{n}-{noted[n]}")

    return write_new


def run_available(stream: DataFrame | KeyedStream, sink_path: str, checkpoint: str,
                  name: str | None = None) -> StreamingQuery:
    """Process everything available now, then stop (``availableNow``)."""
    if isinstance(stream, KeyedStream):
        rows, write = stream.rows, write_keyed_batches(stream, sink_path, f"{checkpoint}/read_at")
    else:
        rows, write = stream, write_batches(sink_path)
    writer = (rows.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        writer = writer.queryName(name)
    query = writer.start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return query
