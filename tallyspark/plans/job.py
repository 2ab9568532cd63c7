"""The layered pipeline as a production job.

Each layer is computed once: written to a new version folder, gated on the
stored rows, then published as the layer's tables (``tables.publish_tables``).
The next layer reads the published tables, so lineage is cut at every layer
and a lost executor only ever recomputes work inside one layer. Reports read
the stored enriched table.

``run_layers`` takes any three sources (``landing.reference_files`` for the
reference's CSV/JSON files, ``star.sources`` for the driver tables) and a
``layers.SalesConfig`` with their keys and code tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.parsing import total
from tallyspark.operators import quality as qa
from tallyspark.operators.keyed import key_list
from tallyspark.plans import layers, star
from tallyspark.plans.landing import CORRUPT
from tallyspark.session import shared_dir
from tallyspark.sources import tables

RAW = ("raw_customers", "raw_products", "raw_orders")


@dataclass
class PipelineRun:
    written: dict[str, int]
    reports: dict[str, DataFrame]
    location: str
    # source rows minus raw rows per raw table (copies the dedup removed)
    duplicates_removed: dict[str, int] = field(default_factory=dict)
    # NULLs by column of each raw table
    null_profile: dict[str, dict[str, int]] = field(default_factory=dict)
    # rows that a rule found but that do not stop the job by themselves: (failed, checked)
    reported: dict[str, tuple[int, int]] = field(default_factory=dict)


# The share of rows that may fail a reported rule before it stops the job.
MAX_SHARES = {"unparsed_date": 0.05, "unparsed_price": 0.05, "corrupt_record": 0.05}


def run_layers(spark: SparkSession, src: star.Sources, cfg: layers.SalesConfig,
               location: str | None = None, suffix: str = "",
               database: str | None = None, verify_keys: bool = True,
               max_shares: Mapping[str, float] | None = None, keep_versions: int = 2) -> PipelineRun:
    """Raw → enriched → aggregated. With ``database`` the tables live in that
    database (created at ``location`` if missing) under qualified names.

    ``verify_keys`` re-checks key uniqueness on the stored raw tables (a
    grouped pass over their keys, as the reference asserts). The raw layer's
    ``row_number() = 1`` de-duplication already guarantees it, so large
    deployments can turn it off: the raw gate then uses only counts observed
    during the write (rows, NULL keys) and schema checks.

    Dates and prices that did not parse and corrupt records are counted in
    ``reported``; a share above the rule's entry in ``max_shares`` (default
    MAX_SHARES) stops the job before the layer is published. Every published
    table is read back and its rows counted."""
    shares = {**MAX_SHARES, **(max_shares or {})}
    profile: dict[str, dict[str, int]] = {}
    reported: dict[str, tuple[int, int]] = {}

    def share_rule(rule: str, subject: str, checked: int, failed: int) -> DataFrame:
        reported[f"{rule}({subject})"] = (int(failed), int(checked))
        return qa.known_rule(spark, rule, subject, checked, failed,
                             allowed=int(shares.get(rule, 0) * checked))

    def publish(layer: dict[str, DataFrame], gate, observe=None) -> dict[str, int]:
        rows = tables.publish_tables(spark, layer, location, gate, observe=observe,
                                     observed=observed, keep_versions=keep_versions)
        stored_rows = {r["table"]: r["rows"] for r in tables.read_back_counts(spark, list(rows)).collect()}
        if stored_rows != rows:
            raise RuntimeError(f"Stored tables differ from what was written: {stored_rows} and {rows}")
        return rows

    location = location or shared_dir(spark, "layers")
    prefix = ""
    if database:
        tables.create_database(spark, database, f"{location.rstrip('/')}/{database}.db")
        prefix = f"{database}."
    name = lambda n: f"{prefix}{n}{suffix}"
    written: dict[str, int] = {}

    # Counts and totals the gates need are observed while each table is
    # written, so no gate re-scans a large table.
    observed: dict = {}

    # raw layer: keys unique and present, required columns present, names standard
    raw = layers.raw_layer(src, cfg.specs)

    raw_tables = {name(k): v for k, v in raw.tables("raw").items()}
    null_keys = {}
    for n in RAW:
        any_null = F.lit(False)
        for k in key_list(cfg.specs[n.removeprefix("raw_")].key):
            any_null = any_null | F.col(k).isNull()
        null_keys[name(n)] = {"null_key": F.count_if(any_null)} | {
            f"null_{c}": F.count_if(F.col(c).isNull()) for c in raw_tables[name(n)].columns}

    def raw_gate(staged: dict[str, DataFrame]) -> None:
        for n in RAW:
            seen = observed[name(n)]
            profile[n] = {c: int(seen[f"null_{c}"]) for c in staged[name(n)].columns}
            if CORRUPT in profile[n]:
                qa.gate(share_rule("corrupt_record", n, seen["rows"], seen["rows"] - profile[n][CORRUPT]))
        if verify_keys:
            qa.gate(layers.raw_rules(layers.Layer(*(staged[name(n)] for n in RAW)), cfg.specs))
            return
        rules = []
        for n in RAW:
            seen, subject = observed[name(n)], n
            rules += [
                qa.known_rule(spark, "not_empty", subject, seen["rows"], int(seen["rows"] == 0)),
                qa.known_rule(spark, "null_key", subject, seen["rows"], seen["null_key"]),
                qa.required_columns_rule(staged[name(n)],
                                         layers.RAW_REQUIRED[n.removeprefix("raw_")], subject),
                qa.column_naming_rule(staged[name(n)], subject),
            ]
        qa.gate(qa.combine(*rules))

    written |= publish(raw_tables, raw_gate, null_keys)
    stored = layers.Layer(*(spark.table(name(n)).drop(CORRUPT) for n in RAW))
    # a count of its own: one observed below the dedup's shuffle may count a retried task twice
    removed = {n: df.count() - written[name(n)]
               for n, df in zip(RAW, (src.customers, src.products, src.order_rows or src.orders), strict=True)}

    # enriched layer over the stored raw tables: no row lost, every category resolved
    enriched = layers.enriched_layer(stored, cfg.category_codes, cfg.sub_category_codes)
    orders_name = name("enriched_orders")
    watch = {orders_name: {
        "null_category": F.count_if(F.col("category").isNull()),
        "unparsed_date": F.count_if(layers.unparsed_date()),
        "profit_total": F.round(total("profit"), 2),
    }}
    # both the text and the number are needed to tell a price that did not parse from none
    prices = stored.products.agg(F.count("*").alias("rows"),
                                 F.count_if(layers.unparsed_price()).alias("failed")).first()

    def enriched_gate(staged: dict[str, DataFrame]) -> None:
        seen = observed[orders_name]
        rows = lambda n: observed[name(n)]["rows"]
        qa.gate(qa.combine(
            qa.known_rule(spark, "null_category", "enriched_orders", seen["rows"],
                          seen["null_category"]),
            share_rule("unparsed_date", "enriched_orders", seen["rows"], seen["unparsed_date"]),
            share_rule("unparsed_price", "enriched_products", prices["rows"], prices["failed"]),
            qa.count_match_rule(spark, rows("raw_orders"), rows("enriched_orders"),
                                "orders after joins"),
            qa.count_match_rule(spark, rows("raw_customers"), rows("enriched_customers"),
                                "customers"),
            qa.count_match_rule(spark, rows("raw_products"), rows("enriched_products"),
                                "products"),
            qa.required_columns_rule(staged[orders_name], layers.ENRICHED_REQUIRED,
                                     "enriched_orders"),
        ))

    written |= publish({name(k): v for k, v in enriched.tables("enriched").items()},
                       enriched_gate, watch)
    enriched_orders = spark.table(orders_name)

    # aggregated layer: totals reconcile, categories exactly the code table's
    summary_name = name("agg_profit_summary")

    def summary_gate(staged: dict[str, DataFrame]) -> None:
        summary = staged[summary_name]
        qa.gate(qa.combine(
            qa.known_total_rule(observed[orders_name]["profit_total"], summary,
                                "agg_profit_summary"),
            qa.required_columns_rule(summary, layers.SUMMARY_REQUIRED, "agg_profit_summary"),
            qa.accepted_values(summary, "category", cfg.categories, "agg_profit_summary"),
        ))

    written |= publish({summary_name: layers.aggregated_layer(enriched_orders)}, summary_gate)
    return PipelineRun(written, layers.reports(enriched_orders), location, removed, profile, reported)


def run(spark: SparkSession, sf_dir: str, location: str | None = None,
        suffix: str = "", database: str | None = None, verify_keys: bool = True,
        max_shares: Mapping[str, float] | None = None) -> PipelineRun:
    """The layered job over the driver tables."""
    return run_layers(spark, star.sources(spark, sf_dir), star.config(), location, suffix,
                      database, verify_keys, max_shares)
