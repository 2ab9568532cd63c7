"""The layers kept up to date from newly landed files.

``advance`` takes what has landed since the last snapshot and publishes the
next one (``sources.snapshots``): ledger, dimensions, raw and enriched order
lines and the profit summary change together or not at all.

* *Ledger.* A table of the landed files (path, length, time of change) already
  taken in. A file that is not in it is new; a run that dies before its commit
  leaves the ledger as it was, so its files are taken again.
* *Parts.* Order lines are stored in parts by ``part``, an expression over their
  key that puts keys which arrive together in one part (a range of order
  numbers, the year in an order id). Only the parts of new lines are read and
  rewritten: the winners stored there meet the new lines in the layer's own
  de-duplication, which gives the winners of all lines as it takes the least
  row in a total order. A dimension row that changed rewrites the enriched
  lines of the parts that refer to it.
* *Summary.* Kept as exact sums and counts by group, to which the rewritten
  parts' enriched lines add what they hold now and from which they subtract
  what they held. A group without lines goes.

A line is never taken out: landed files hold lines to add, or further copies
of lines, and the layers' rule picks among all copies ever landed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.parsing import SUM_SCALE, total
from tallyspark.operators import aggregate as agg
from tallyspark.operators import quality as qa
from tallyspark.operators.transforms import standardize_column_names, trim_string_columns
from tallyspark.plans import layers
from tallyspark.sources import snapshots
from tallyspark.sources.snapshots import Snapshot, TableVersion, stage

LEDGER, RAW, ENRICHED, SUMMARY = "ledger", "raw_orders", "enriched_orders", "profit_parts"
CUSTOMERS, PRODUCTS = "enriched_customers", "enriched_products"
PART = "_part"
MEASURES = ("profit", "price")


@dataclass(frozen=True)
class Increment:
    """What one call of ``advance`` did."""

    snapshot: Snapshot
    files: int
    raw_parts: int  # parts rewritten
    enriched_parts: int
    rows_before: int  # stored lines of the parts that were read
    rows_stored: int  # all stored lines before


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modificationTime) of the files in a folder; a listing only."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
            .select("path", "length", "modificationTime"))


def _changed_keys(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame | None:
    """Keys of dimension rows that came, went or changed; None before the first run."""
    if old is None:
        return None
    old = old.select(new.columns)
    return new.exceptAll(old).unionByName(old.exceptAll(new)).select(key).distinct()


def contributions(enriched: DataFrame, sign: int = 1) -> DataFrame:
    """Exact sums and counts by summary group. ``_with_`` counts tell a sum
    of nothing (NULL) from zero."""
    grouped = enriched.withColumn("year", F.year("order_date")).groupBy(*agg.SUMMARY_KEYS)
    return grouped.agg(
        (sign * F.count("*")).alias("lines"), (sign * F.count("order_id")).alias("order_count"),
        *[x for m in MEASURES for x in ((sign * total(m)).cast(f"decimal(38,{SUM_SCALE})").alias(m),
                                        (sign * F.count(m)).alias(f"with_{m}"))])


def merge(parts: DataFrame) -> DataFrame:
    """Contributions of equal groups added up; groups without lines are left out."""
    counts = ["lines", "order_count", *(f"with_{m}" for m in MEASURES)]
    return (parts.groupBy(*agg.SUMMARY_KEYS)
            .agg(*[F.sum(c).alias(c) for c in counts],
                 *[F.sum(m).cast(f"decimal(38,{SUM_SCALE})").alias(m) for m in MEASURES])
            .where("lines > 0").select(*agg.SUMMARY_KEYS, "lines", "order_count",
                                       *[c for m in MEASURES for c in (m, f"with_{m}")]))


def summary(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """The layer's profit summary, from the stored sums."""
    rounded = lambda m: F.when(F.col(f"with_{m}") > 0, F.round(m, 2).cast("double"))
    return snapshot.table(spark, SUMMARY).select(
        *agg.SUMMARY_KEYS, rounded("profit").alias("total_profit"), "order_count",
        rounded("price").alias("total_revenue"))


def advance(spark: SparkSession, root: str, landing: str, read: Callable[[list[str]], DataFrame],
            customers: DataFrame, products: DataFrame, cfg: layers.SalesConfig, part: Column,
            keep: int = 2, gate: Callable[[DataFrame, DataFrame], None] | None = None) -> Increment:
    """Takes the new files of ``landing`` in. ``read`` gives the order lines of
    some files, with source column names; ``customers`` and ``products`` are
    the whole dimension sources; ``part`` is over the standard column names and
    the same in every run. ``gate`` gets the staged raw and enriched lines of
    the rewritten parts and raises to stop; so do missing order keys."""
    spec = cfg.specs["orders"]
    base = snapshots.latest(spark, root)
    have = lambda name: name in base.tables
    files = landed_files(spark, landing)
    if have(LEDGER):
        files = files.join(base.table(spark, LEDGER), files.columns, "left_anti")
    ledger = stage(spark, root, LEDGER, files)
    # the names of the new files are what a reader needs: one short row a file
    paths = [r[0] for r in Snapshot(root, 0, {LEDGER: ledger}).table(spark, LEDGER).select("path").collect()]

    dims = {
        CUSTOMERS: layers.enriched_customers(layers.standardize(customers, cfg.specs["customers"])),
        PRODUCTS: layers.enriched_products(layers.standardize(products, cfg.specs["products"])),
    }
    staged = {name: stage(spark, root, name, df) for name, df in dims.items()}
    dims = {name: Snapshot(root, 0, staged).table(spark, name) for name in dims}
    if not paths and not have(RAW):
        raise ValueError(f"Nothing has landed in {landing}")

    # parts of new lines
    changes: dict[str, TableVersion] = dict(staged)
    raw_parts: list[str] = []
    if paths:
        lines = trim_string_columns(standardize_column_names(read(paths))).withColumn(PART, part)
        sizes = snapshots.part_rows(lines, PART)
        raw_parts = list(sizes)
        if None in raw_parts:
            raise ValueError("some landed lines have no part: their key is NULL")
        if have(RAW):
            stored = base.table(spark, RAW, raw_parts).withColumn(PART, part)
            sizes += snapshots.part_rows(stored, PART)
            lines = lines.unionByName(stored)
        new_raw = snapshots.stage_first(spark, root, RAW, lines, PART, sizes, spec.key, spec.ordering())
        carried = dict(base.tables[RAW].folders) if have(RAW) else {}
        changes[RAW] = TableVersion(new_raw.schema, {**carried, **new_raw.folders})
        changes[LEDGER] = TableVersion(ledger.schema, {
            **(base.tables[LEDGER].folders if have(LEDGER) else {}), str(base.number + 1): ledger.folders[""]})
    raw = Snapshot(root, 0, {RAW: changes.get(RAW) or base.tables[RAW]})

    # and parts that refer to a changed dimension row
    enriched_parts = set(raw_parts)
    for name, key, columns in ((CUSTOMERS, "customer_id", ("customer_name", "country")),
                               (PRODUCTS, "product_id", ("category", "sub_category"))):
        old = base.table(spark, name).select(key, *columns) if have(name) else None
        keys = _changed_keys(old, dims[name].select(key, *columns), key)
        if keys is not None and not keys.isEmpty():
            touched = raw.table(spark, RAW).join(keys, key, "left_semi").select(part.cast("string")).distinct()
            enriched_parts |= {r[0] for r in touched.collect()}

    rows_before = rows_stored = 0
    if enriched_parts:
        wide = layers.enriched_orders(raw.table(spark, RAW, enriched_parts), dims[CUSTOMERS], dims[PRODUCTS],
                                      cfg.category_codes, cfg.sub_category_codes).withColumn(PART, part)
        new = stage(spark, root, ENRICHED, wide, PART, from_parts=True)
        rewritten = Snapshot(root, 0, {ENRICHED: new}).table(spark, ENRICHED)
        if gate is not None:
            gate(raw.table(spark, RAW, enriched_parts), rewritten)
        sums = contributions(rewritten)
        if have(ENRICHED):
            replaced = base.table(spark, ENRICHED, enriched_parts)
            rows_before, rows_stored = replaced.count(), base.table(spark, ENRICHED).count()
            sums = sums.unionByName(contributions(replaced, -1)).unionByName(base.table(spark, SUMMARY))
        changes[ENRICHED] = TableVersion(new.schema, {
            **(base.tables[ENRICHED].folders if have(ENRICHED) else {}), **new.folders})
        changes[SUMMARY] = stage(spark, root, SUMMARY, merge(sums))
    made = snapshots.commit(spark, base, changes)
    snapshots.expire(spark, root, keep)
    return Increment(made, len(paths), len(raw_parts), len(enriched_parts), rows_before, rows_stored)


def rules(raw: DataFrame, enriched: DataFrame, spec: layers.SourceSpec) -> DataFrame:
    """The gate's rules over rewritten parts: keys unique, no line lost,
    every category known."""
    return qa.row_rules(enriched, ENRICHED, {"null_category": F.col("category").isNull()}, key=spec.key,
                        match_rows={"orders after joins": raw})
