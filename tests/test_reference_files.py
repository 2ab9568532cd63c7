"""The layered job over files laid out like the reference's sources."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from tallyspark.plans import job, landing, layers
from tallyspark.sources import files

# Invented rows; only the column names, the date layout and the product-id codes are given.
CUSTOMERS = (
    'Customer ID,Customer Name,email,phone,address,Segment,Country,City,State,Postal Code,Region\n'
    'K-01,Linnea Berg,lb@mail.test,08-100,"Norra vägen 4\nBox 12",Home Office,Sweden,Umeå,'
    'Västerbotten,90325,North\n'
    'K-02,Tomas (NEW) Reiter,tr@mail.test,,Am Kai 7,Corporate,Austria,Linz,Oberösterreich,4020,South\n'
    'K-03, Zoë Quist ,zq@mail.test,08-300,"Gränd 1\nHus C\nPort 9",Consumer,Sweden,Lund,Skåne,22222,South\n'
)
PRODUCTS = (
    'Product ID,Category,Sub-Category,Product Name,State,Price per product\n'
    'FUR-BO-31,Furniture,Bookcases,Tall shelf,Skåne,140.25\n'
    'TEC-CO-52,Technology,Copiers,Copier B,Wien,899\n'
    'TEC-CO-52,Technology,Copiers,Copier A,Wien,905.5\n'
    'OFF-FA-73,Office Supplies,Fasteners,Clips,Wien,on request\n'
)

# one bad row of a few is a large share
TINY = dict.fromkeys(("unparsed_price", "unparsed_date", "corrupt_record"), 0.5)


def order(row, number, ordered, shipped, customer, product, quantity, price, discount, profit):
    return {"Row ID": row, "Order ID": number, "Order Date": ordered, "Ship Date": shipped,
            "Ship Mode": "Courier", "Customer ID": customer, "Product ID": product,
            "Quantity": quantity, "Price": price, "Discount": discount, "Profit": profit}


ORDERS = [
    order(11, "N-900", "30/11/2014", "2/12/2014", "K-01", "FUR-BO-31", 2, 280.5, 0.0, 40.1251),
    order(12, "N-901", "9/5/2016", "12/5/2016", "K-02", "TEC-CO-52", 1, 899.0, 0.1, -12.505),
    order(13, "N-902", "17/5/2016", "17/5/2016", "K-03", "OFF-FA-73", 30, 36.0, 0.0, 9.999),
    order(14, "N-903", "2/1/2017", "8/1/2017", "K-03", "OFF-ST-88", 5, 71.0, 0.2, 3.3),
]
SCHEMA = ("`Row ID` bigint, `Order ID` string, `Order Date` string, `Ship Date` string, "
          "`Ship Mode` string, `Customer ID` string, `Product ID` string, `Quantity` bigint, "
          "`Price` double, `Discount` double, `Profit` double")


def write_sources(folder, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS):
    (folder / "Customer.csv").write_bytes(customers.encode("latin-1"))
    (folder / "Products.csv").write_text(products)
    (folder / "Orders.json").write_text(json.dumps(orders, indent=2))
    return [str(folder / n) for n in ("Customer.csv", "Products.csv", "Orders.json")]


@pytest.fixture
def reference_sources(spark, tmp_path):
    return landing.reference_files(spark, *write_sources(tmp_path))


def new_suffix():
    return "_" + uuid.uuid4().hex[:8]


def test_files_read_as_the_reference_reads_them(reference_sources):
    cust = {r["Customer ID"]: r for r in reference_sources.customers.collect()}
    assert cust["K-01"]["address"] == "Norra vägen 4\nBox 12"
    assert cust["K-03"]["Customer Name"] == " Zoë Quist "
    assert all(r["corrupt_record"] is None for r in cust.values())
    assert reference_sources.products.count() == reference_sources.orders.count() == 4


def test_layers_over_reference_files(spark, reference_sources):
    suffix = new_suffix()
    run = job.run_layers(spark, reference_sources, layers.REFERENCE_CONFIG, suffix=suffix, max_shares=TINY)
    counts = {n.removesuffix(suffix): c for n, c in run.written.items()}
    assert counts["raw_products"] == 3          # duplicate product id removed
    assert run.duplicates_removed == {"raw_customers": 0, "raw_products": 1, "raw_orders": 0}
    assert counts["raw_orders"] == counts["enriched_orders"] == 4
    assert run.null_profile["raw_customers"]["phone"] == 1
    assert run.reported["unparsed_price(enriched_products)"] == (1, 3)
    assert run.reported["unparsed_date(enriched_orders)"] == (0, 4)
    assert run.reported["corrupt_record(raw_customers)"] == (0, 3)

    customers = {r["customer_id"]: r for r in spark.table(f"enriched_customers{suffix}").collect()}
    assert customers["K-02"]["customer_name"] == "Tomas NEW Reiter"
    assert customers["K-03"]["customer_name"] == "Zo Quist"       # trimmed, ASCII letters only
    assert customers["K-03"]["address"] == "Gränd 1, Hus C, Port 9"

    products = {r["product_id"]: r for r in spark.table(f"enriched_products{suffix}").collect()}
    assert products["OFF-FA-73"]["price_per_product"] is None
    assert products["TEC-CO-52"]["product_name"] == "Copier A"    # lowest by tie-breakers

    orders = {r["row_id"]: r for r in spark.table(f"enriched_orders{suffix}").collect()}
    assert orders[11]["profit"] == 40.13 and orders[13]["profit"] == 10.0
    assert orders[11]["ship_date"] == dt.date(2014, 12, 2)
    # product missing from the catalog: decoded from the id
    assert (orders[14]["category"], orders[14]["sub_category"]) == ("Office Supplies", "Storage")
    assert orders[14]["customer_name"] == "Zo Quist"

    summary = spark.table(f"agg_profit_summary{suffix}")
    assert summary.count() == 4
    years = [tuple(r) for r in run.reports["profit_by_year"].collect()]
    assert years == [(2014, 40.13, 1), (2016, -2.51, 2), (2017, 3.3, 1)]


def test_gate_stops_unknown_category(spark, reference_sources):
    bad = reference_sources.orders.withColumn("Product ID", F.lit("XYZ-QQ-1"))
    src = reference_sources.__class__(reference_sources.customers, reference_sources.products, bad)
    with pytest.raises(AssertionError, match="null_category"):
        job.run_layers(spark, src, layers.REFERENCE_CONFIG, suffix=new_suffix())


def test_unparseable_dates_stop_the_job_unless_allowed(spark, tmp_path):
    late = [o | {"Order Date": "May 5th", "Ship Date": "later"} for o in ORDERS]
    src = landing.reference_files(spark, *write_sources(tmp_path, orders=late))
    suffix = new_suffix()
    with pytest.raises(AssertionError, match="unparsed_date.*4 of 4"):
        job.run_layers(spark, src, layers.REFERENCE_CONFIG, suffix=suffix)
    assert not spark.catalog.tableExists(f"enriched_orders{suffix}")  # not published
    run = job.run_layers(spark, src, layers.REFERENCE_CONFIG, suffix=new_suffix(),
                         max_shares={**TINY, "unparsed_date": 1.0})
    assert run.reported["unparsed_date(enriched_orders)"] == (4, 4)


def test_records_with_extra_fields_are_kept_and_counted(spark, tmp_path):
    ragged = PRODUCTS + "FUR-TA-90,Furniture,Tables,Desk,Wien,55,surplus\n"
    src = landing.reference_files(spark, *write_sources(tmp_path, products=ragged))
    suffix = new_suffix()
    run = job.run_layers(spark, src, layers.REFERENCE_CONFIG, suffix=suffix, max_shares=TINY)
    assert run.reported["corrupt_record(raw_products)"] == (1, 4)
    kept = spark.table(f"raw_products{suffix}").where("corrupt_record IS NOT NULL").collect()
    assert [r["corrupt_record"] for r in kept] == ["FUR-TA-90,Furniture,Tables,Desk,Wien,55,surplus"]
    assert "corrupt_record" not in spark.table(f"enriched_products{suffix}").columns


def test_columns_are_found_by_name(spark, tmp_path):
    rows = [line.split(",") for line in PRODUCTS.splitlines()]
    swapped = "\n".join(",".join(r[::-1]) for r in rows) + "\n"
    src = landing.reference_files(spark, *write_sources(tmp_path, products=swapped))
    got = {r["Product ID"]: r["Category"] for r in src.products.collect()}
    assert got == {"FUR-BO-31": "Furniture", "TEC-CO-52": "Technology", "OFF-FA-73": "Office Supplies"}


def test_ndjson_orders_with_schema(spark, tmp_path):
    path = tmp_path / "orders.ndjson"
    path.write_text("\n".join(json.dumps(o) for o in ORDERS))
    df = files.read_json(spark, str(path), SCHEMA)
    assert df.count() == 4 and df.columns[0] == "Row ID"


def test_command_line_over_files(spark, tmp_path, capsys):
    from tallyspark.__main__ import main

    customers, products, orders = write_sources(tmp_path)
    db = "sales_" + uuid.uuid4().hex[:8]
    main(["files", "--customers", customers, "--products", products, "--orders", orders,
          "--database", db, "--show", "3", "--max-share", "0.5"])
    out = capsys.readouterr().out
    first = json.loads(out.splitlines()[0])
    assert first["written"][f"{db}.enriched_orders"] == 4
    assert first["reported"]["unparsed_price(enriched_products)"] == [1, 3]
    assert spark.table(f"{db}.agg_profit_summary").count() == 4
    assert "-- profit_by_customer_year" in out
