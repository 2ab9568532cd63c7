"""The reference's source files as the three pipeline sources.

* customers: CSV with a header, Latin-1, quoted fields with newlines
  (addresses); a large file is read by many tasks (``split=True``);
* products: plain CSV with a header (splittable);
* orders: a pretty-printed JSON array, a large one read by many tasks where
  ``orders_schema`` is given; NDJSON is read with ``orders_multi_line=False``
  and splits by block.

CSV columns are found by their names in the header, read as text and typed by
the enrichment layer (price with ``try_cast``, dates with ``try_to_date``), so
a shifted record never fails the read. A record with too many or too few
fields keeps its text in the column CORRUPT, which the raw layer carries and
counts. The JSON key names of the orders file are not fixed, so without
``orders_schema`` its schema is inferred (one extra pass), as the reference
does, by one task per file; with one, records that do not parse are kept in CORRUPT too.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyspark.plans.star import Sources
from tallyspark.sources import files

# The header names of the files.
CUSTOMER_COLUMNS = ("Customer ID", "Customer Name", "email", "phone", "address", "Segment",
                    "Country", "City", "State", "Postal Code", "Region")
PRODUCT_COLUMNS = ("Product ID", "Category", "Sub-Category", "Product Name", "State",
                   "Price per product")


CORRUPT = "corrupt_record"


def _text_schema(columns) -> str:
    return ", ".join(f"`{c}` string" for c in columns)


def reference_files(spark: SparkSession, customers: str, products: str, orders: str,
                    orders_schema: str | None = None, orders_multi_line: bool = True,
                    customers_encoding: str = "latin1") -> Sources:
    return Sources(
        customers=files.read_csv(spark, customers, _text_schema(CUSTOMER_COLUMNS), multi_line=True,
                                 encoding=customers_encoding, corrupt_column=CORRUPT, split=True),
        products=files.read_csv(spark, products, _text_schema(PRODUCT_COLUMNS),
                                corrupt_column=CORRUPT),
        orders=files.read_json(spark, orders, orders_schema, multi_line=orders_multi_line,
                               corrupt_column=CORRUPT if orders_schema else None,
                               split=orders_multi_line and orders_schema is not None),
    )
