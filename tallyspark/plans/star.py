"""The sales star, derived from the TPC-H style tables.

The pipeline expects three sources (customers, products, order lines) laid
out the way the source files arrive: display-style column names, dates as
``d/M/yyyy`` text, prices as text, an unrounded signed profit and product ids
that carry their category codes. This module derives exactly that from the
parquet tables, lazily, so every source grows with the data it is read from.

Source facts:
* customers  ← customer ⋈ nation ⋈ region; the address is "nation\\nregion". The
  name spells the customer's number in letters, with the noise of an export
  (see ``customer_name``), so cleaned names differ between customers.
* products   ← part. Id = first three letters of ``p_type`` - two-digit brand
  number - part key, so characters 1-3 and 5-6 hold the codes. Parts of size
  ``MISALIGNED_SIZE`` carry brand text in the price field (a shifted record).
  The product *dimension* of enrichment lacks parts larger than
  ``CATALOG_MAX_SIZE``, so their order lines find no product row and the id
  must be decoded; the product source itself holds every part.
* order lines ← lineitem, with orders and part joined on the left: a line
  without an order or part stays, with NULL in what it would have brought
  (``unmatched_order`` and ``unmatched_part`` count them). ``(Order ID, Line
  Number)`` is the business key and is *not* unique in lineitem; profit is
  ``price × (0.04 − discount)`` in exact decimal arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Data facts of the driver tables, used as the code tables of this star.
STAR_CATEGORY_CODES = {
    "ECO": "ECONOMY",
    "LAR": "LARGE",
    "MED": "MEDIUM",
    "PRO": "PROMO",
    "SMA": "SMALL",
    "STA": "STANDARD",
}
BRAND_COUNT = 25
STAR_SUB_CATEGORY_CODES = {f"{n:02d}": f"Brand#{n}" for n in range(1, BRAND_COUNT + 1)}
STAR_CATEGORIES = sorted(STAR_CATEGORY_CODES.values())
STAR_YEARS = (1995, 2001)  # order years the generator produces

CATALOG_MAX_SIZE = 49
MISALIGNED_SIZE = 1
SOURCE_DATE_FORMAT = "d/M/yyyy"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Declared schemas of the driver tables. Reading with a schema skips the
# footer-inference job Spark otherwise runs for every ``read.parquet``.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def product_code(p_type: str | Column, p_brand: str | Column, partkey: str | Column) -> Column:
    """``TYP-BB-KEY``: type prefix, two-digit brand number, part key."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.concat_ws(
        "-",
        F.substring(c(p_type), 1, 3),
        F.lpad(F.substring(c(p_brand), 7, 2), 2, "0"),
        c(partkey).cast("string"),
    )


def customer_name(c_name: str | Column) -> Column:
    """The number of ``Customer#000000123`` in letters, as a noisy two-word name
    that cleaning turns into e.g. ``Aaaaaabcd Trading``."""
    c = F.col(c_name) if isinstance(c_name, str) else c_name
    letters = F.translate(F.substring(c, 10, 1 << 20), "0123456789", "abcdefghij")
    return F.concat(F.upper(F.substring(letters, 1, 1)), F.lit("4@"),
                    F.substring(letters, 2, 1 << 20), F.lit(" 7Trading$"))


def customer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        customer
        .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("Customer ID"),
            customer_name("c_name").alias("Customer Name"),
            F.col("c_mktsegment").alias("Segment"),
            F.col("n_name").alias("Country"),
            F.col("r_name").alias("Region"),
            F.concat(F.col("n_name"), F.lit("\n"), F.col("r_name")).alias("Address"),
        )
    )


def product_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part."""
    return _products(table(spark, sf_dir, "part"))


def catalog_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products of enrichment: without parts larger than ``CATALOG_MAX_SIZE``."""
    return _products(table(spark, sf_dir, "part").filter(F.col("p_size") <= CATALOG_MAX_SIZE))


def _products(part: DataFrame) -> DataFrame:
    return part.select(
        product_code("p_type", "p_brand", "p_partkey").alias("Product ID"),
        F.col("p_type").alias("Category"),
        F.col("p_brand").alias("Sub-Category"),
        F.col("p_name").alias("Product Name"),
        F.when(F.col("p_size") == MISALIGNED_SIZE, F.col("p_brand"))
         .otherwise(F.col("p_retailprice").cast("string")).alias("Price per product"),
    )


def line_profit(price: str | Column, discount: str | Column) -> Column:
    """``price × (0.04 − discount)`` as decimal(18,4): signed, four places."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    margin = F.lit(0.04).cast("decimal(4,2)") - c(discount).cast("decimal(4,2)")
    return (c(price).cast("decimal(18,2)") * margin).cast("decimal(18,4)")


ORDER_COLUMNS = ("Order ID", "Line Number", "Order Date", "Ship Date", "Customer ID", "Product ID",
                 "Quantity", "Price", "Discount", "Profit")
_FROM_ORDERS = {"Order Date", "Customer ID"}
_FROM_PART = {"Product ID"}


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of lineitem that order lines are made of."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_shipdate")


def first_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (order, line): the lowest price, then the earliest ship date.
    Everything else in an order line depends on these rows, so removing copies
    here, before any join, gives the lines that removing them after would."""
    from tallyspark.operators.keyed import remove_duplicate_keys

    return remove_duplicate_keys(line_items(spark, sf_dir), ["l_orderkey", "l_linenumber"],
                                 order_by=["l_extendedprice", "l_shipdate"])


def order_source(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ORDER_COLUMNS,
                 lines: DataFrame | None = None) -> DataFrame:
    """Order lines with the columns asked for. A table is only joined if it
    brings one of them."""
    df = line_items(spark, sf_dir) if lines is None else lines
    if _FROM_PART & set(columns):
        # made before the join, whose rows then carry the code and not what it is made of
        part = table(spark, sf_dir, "part").select(
            "p_partkey", product_code("p_type", "p_brand", "p_partkey").alias("p_code"))
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    if _FROM_ORDERS & set(columns):
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    made = {
        "Order ID": lambda: F.col("l_orderkey"),
        "Line Number": lambda: F.col("l_linenumber"),
        "Order Date": lambda: F.date_format("o_orderdate", SOURCE_DATE_FORMAT),
        "Ship Date": lambda: F.date_format("l_shipdate", SOURCE_DATE_FORMAT),
        "Customer ID": lambda: F.col("o_custkey"),
        "Product ID": lambda: F.col("p_code"),
        "Quantity": lambda: F.col("l_quantity").cast("bigint"),
        "Price": lambda: F.col("l_extendedprice"),
        "Discount": lambda: F.col("l_discount"),
        "Profit": lambda: line_profit("l_extendedprice", "l_discount"),
    }
    return df.select(*[made[c]().alias(c) for c in ORDER_COLUMNS if c in columns])


def config():
    """Keys, code tables and years of this star (see ``layers.SalesConfig``)."""
    from tallyspark.plans.layers import DEFAULT_SPECS, SalesConfig

    return SalesConfig(DEFAULT_SPECS, STAR_CATEGORY_CODES, STAR_SUB_CATEGORY_CODES, STAR_YEARS)


@dataclass(frozen=True)
class Sources:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    #: a cheaper frame with as many rows as ``orders``, if there is one
    order_rows: DataFrame | None = None


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(customer_source(spark, sf_dir), catalog_source(spark, sf_dir),
                   order_source(spark, sf_dir), line_items(spark, sf_dir))  # joins on unique keys
