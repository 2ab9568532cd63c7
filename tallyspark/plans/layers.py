"""The medallion layers: raw → enriched → aggregated, plus the reports.

Every layer is a lazy DataFrame plan; nothing runs until a sink or a report
asks for rows, so Catalyst sees each layer whole (pruning, pushdown, one
projection per chain of transforms)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.codes import REFERENCE_CATEGORY_CODES, REFERENCE_SUB_CATEGORY_CODES
from tallyspark.functions.parsing import parse_date, try_double
from tallyspark.operators import aggregate as agg
from tallyspark.operators import quality as qa
from tallyspark.operators.enrich import Dimension, enrich
from tallyspark.operators.keyed import KeySpec, remove_duplicate_keys
from tallyspark.operators.transforms import (
    cast_price_column,
    clean_customer_name,
    derive_category_from_product_id,
    normalize_address,
    parse_date_column,
    round_profit,
    standardize_column_names,
    trim_string_columns,
)
from tallyspark.plans.star import Sources


@dataclass(frozen=True)
class SourceSpec:
    """Business key of a source, the order that picks the surviving row (of
    which ``dates`` are ordered as dates, not as the text they arrive as), and
    whether to declare the key unique to Catalyst after the dedup (see
    ``remove_duplicate_keys(declare_unique=...)``; off by default)."""

    key: KeySpec
    order_by: Sequence[str] = field(default_factory=tuple)
    declare_unique: bool = False
    dates: Sequence[str] = field(default_factory=tuple)

    def ordering(self) -> list:
        return [parse_date(c).asc_nulls_first() if c in self.dates else c for c in self.order_by]


DEFAULT_SPECS = {
    "customers": SourceSpec("customer_id"),
    "products": SourceSpec("product_id"),
    "orders": SourceSpec(("order_id", "line_number"), ("price", "ship_date"),
                         dates=("ship_date",)),
}
# The reference's own files key order lines by row_id.
REFERENCE_FILE_SPECS = {
    "customers": SourceSpec("customer_id"),
    "products": SourceSpec("product_id"),
    "orders": SourceSpec("row_id"),
}

# The columns each layer must carry (checked on the schema, no job).
RAW_REQUIRED = {
    "customers": ("customer_id", "customer_name", "segment", "country", "region"),
    "products": ("product_id", "category", "sub_category", "product_name"),
    "orders": ("order_id", "customer_id", "product_id", "quantity", "price", "profit"),
}
ENRICHED_REQUIRED = ("order_id", "customer_id", "product_id", "profit", "customer_name",
                     "country", "category", "sub_category")
SUMMARY_REQUIRED = ("year", "category", "sub_category", "customer_name", "total_profit")


@dataclass(frozen=True)
class SalesConfig:
    """What differs between data sets: keys, code tables, the year range."""

    specs: Mapping[str, SourceSpec]
    category_codes: Mapping[str, str]
    sub_category_codes: Mapping[str, str]
    years: tuple[int, int] | None = None

    @property
    def categories(self) -> list[str]:
        return sorted(set(self.category_codes.values()))


# The reference data's order years.
REFERENCE_YEARS = (2014, 2017)
REFERENCE_CONFIG = SalesConfig(REFERENCE_FILE_SPECS, REFERENCE_CATEGORY_CODES,
                               REFERENCE_SUB_CATEGORY_CODES, REFERENCE_YEARS)


@dataclass(frozen=True)
class Layer:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame

    def tables(self, prefix: str) -> dict[str, DataFrame]:
        return {f"{prefix}_customers": self.customers, f"{prefix}_products": self.products,
                f"{prefix}_orders": self.orders}


def standardize(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Raw-layer treatment of one source: rename, trim, de-duplicate."""
    df = trim_string_columns(standardize_column_names(df))
    return remove_duplicate_keys(df, spec.key, order_by=spec.ordering(),
                                 declare_unique=spec.declare_unique)


def raw_layer(src: Sources, specs: Mapping[str, SourceSpec] = DEFAULT_SPECS) -> Layer:
    return Layer(
        customers=standardize(src.customers, specs["customers"]),
        products=standardize(src.products, specs["products"]),
        orders=standardize(src.orders, specs["orders"]),
    )


def raw_rules(raw: Layer, specs: Mapping[str, SourceSpec] = DEFAULT_SPECS) -> DataFrame:
    """The raw layer's gate: every table non-empty, keys unique and not NULL,
    every line with its customer and product ids, required columns present,
    column names in standard form."""
    frames = {"customers": raw.customers, "products": raw.products, "orders": raw.orders}
    failing = {"orders": {"unmatched_order": F.col("customer_id").isNull(),
                          "unmatched_part": F.col("product_id").isNull()}}
    return qa.combine(
        *[qa.row_rules(df, f"raw_{n}", failing.get(n), key=specs[n].key)
          for n, df in frames.items()],
        *[qa.required_columns_rule(df, RAW_REQUIRED[n], f"raw_{n}") for n, df in frames.items()],
        *[qa.column_naming_rule(df, f"raw_{n}") for n, df in frames.items()],
    )


def unparsed_price(price: str = "price_per_product") -> Column:
    """The price has text, but no number."""
    return F.col(price).isNotNull() & try_double(price).isNull()


def price_rules(raw_products: DataFrame, subject: str = "enriched_products") -> DataFrame:
    return qa.row_rules(raw_products, subject, {"unparsed_price": unparsed_price()})


def unparsed_date() -> Column:
    """F3, V10, on enriched lines: the order or ship date did not parse."""
    return F.col("order_date").isNull() | F.col("ship_date").isNull()


def enriched_customers(raw_customers: DataFrame) -> DataFrame:
    return normalize_address(clean_customer_name(raw_customers))


def enriched_products(raw_products: DataFrame) -> DataFrame:
    return cast_price_column(raw_products)


def typed_orders(raw_orders: DataFrame) -> DataFrame:
    """Dates parsed, profit rounded to cents and carried as double (those of
    them that are there)."""
    out = raw_orders
    for name in ("order_date", "ship_date"):
        if name in out.columns:
            out = parse_date_column(out, name)
    if "profit" in out.columns:
        out = round_profit(out)
        out = out.withColumn("profit", out["profit"].cast("double"))
    return out


def enriched_orders(raw_orders: DataFrame, customers: DataFrame | None,
                    products: DataFrame | None,
                    category_codes: Mapping[str, str] = REFERENCE_CATEGORY_CODES,
                    sub_category_codes: Mapping[str, str] = REFERENCE_SUB_CATEGORY_CODES
                    ) -> DataFrame:
    """Order lines + customer name and country + product category and
    sub-category; gaps in the product dimension decoded from the product id.
    A dimension of None is left out, with the columns it brings."""
    return widened_orders(typed_orders(raw_orders), customers, products, category_codes, sub_category_codes)


def widened_orders(typed: DataFrame, customers: DataFrame | None, products: DataFrame | None,
                   category_codes: Mapping[str, str] = REFERENCE_CATEGORY_CODES,
                   sub_category_codes: Mapping[str, str] = REFERENCE_SUB_CATEGORY_CODES
                   ) -> DataFrame:
    """``enriched_orders`` of lines that are typed."""
    dimensions = []
    if customers is not None:
        dimensions.append(Dimension(customers, "customer_id", ("customer_name", "country")))
    if products is not None:
        dimensions.append(Dimension(products, "product_id", ("category", "sub_category")))
    wide = enrich(typed, dimensions)
    if products is None:
        return wide
    return derive_category_from_product_id(wide, category_codes, sub_category_codes)


def enriched_layer(raw: Layer, category_codes: Mapping[str, str] = REFERENCE_CATEGORY_CODES,
                   sub_category_codes: Mapping[str, str] = REFERENCE_SUB_CATEGORY_CODES
                   ) -> Layer:
    customers = enriched_customers(raw.customers)
    products = enriched_products(raw.products)
    orders = enriched_orders(raw.orders, customers, products, category_codes, sub_category_codes)
    return Layer(customers, products, orders)


def aggregated_layer(enriched: DataFrame) -> DataFrame:
    """Profit summary by year, category, sub-category and customer name."""
    return agg.profit_summary(enriched)


REPORTS = {
    "profit_by_year": agg.profit_by_year,
    "profit_by_year_category": agg.profit_by_year_category,
    "profit_by_customer": agg.profit_by_customer,
    "profit_by_customer_year": agg.profit_by_customer_year,
}


def reports(enriched: DataFrame) -> dict[str, DataFrame]:
    return {name: build(enriched) for name, build in REPORTS.items()}


def sql_reports(spark, table: str) -> dict[str, DataFrame]:
    """The reports as SQL over a stored table or a view."""
    return {name: spark.sql(agg.report_sql(table, name)) for name in REPORTS}
