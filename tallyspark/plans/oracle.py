"""Independent DuckDB SQL for every registered query.

The driver registers the parquet tables as views (``lineitem``, ``orders``
...). The CTEs below restate the sales star in plain SQL, written from the
rules in ``star.py``'s docstring rather than generated from the Spark code.

Engine differences handled here:
* DuckDB's RE2 has no look-around, so the first name-cleaning pass becomes a
  capture-group replacement applied twice (each maximal non-letter run
  between a letter and a lowercase letter is removed either way); ``\\s`` is
  spelled as Java's class ``[ \\t\\n\\x0B\\f\\r]``.
* Money is summed and rounded as DECIMAL, as the Spark side does.
* Dates come back from the source timestamps (the ``d/M/yyyy`` text is
  Spark's own round trip), ``year`` is INTEGER.
"""

from __future__ import annotations

# The rules' values, written out here and not taken from the code under test.
CATALOG_MAX_SIZE = 49
MISALIGNED_SIZE = 1
YEARS = (1995, 2001)
CATEGORIES = {"ECO": "ECONOMY", "LAR": "LARGE", "MED": "MEDIUM", "PRO": "PROMO", "SMA": "SMALL",
              "STA": "STANDARD"}
SUB_CATEGORIES = {f"{n:02d}": f"Brand#{n}" for n in range(1, 26)}

JAVA_SPACE = r"[ \t\n\x0B\f\r]"


def clean_name_sql(x: str) -> str:
    inner = r"'([a-zA-Z])[^a-zA-Z]+([a-z])', '\1\2', 'g'"
    s = f"regexp_replace(regexp_replace({x}, {inner}), {inner})"
    s = rf"regexp_replace({s}, '[^a-zA-Z \t\n\x0B\f\r''\-]', '', 'g')"
    s = f"regexp_replace({s}, '^[^a-zA-Z]+|[^a-zA-Z]+$', '', 'g')"
    return f"trim(regexp_replace({s}, '{JAVA_SPACE}+', ' ', 'g'))"


def _case(expr: str, codes: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items())
    return f"CASE {expr} {whens} END"


def product_code_sql(p_type: str, p_brand: str, partkey: str) -> str:
    return (f"substr({p_type}, 1, 3) || '-' || lpad(substr({p_brand}, 7, 2), 2, '0') || '-' || "
            f"CAST({partkey} AS VARCHAR)")


DATE_TEXT = "'%-d/%-m/%Y'"

RAW_CUSTOMERS = """
raw_customers AS (
  SELECT c.c_custkey AS customer_id,
         upper(substr(translate(substr(c.c_name, 10), '0123456789', 'abcdefghij'), 1, 1)) || '4@'
           || substr(translate(substr(c.c_name, 10), '0123456789', 'abcdefghij'), 2)
           || ' 7Trading$' AS customer_name, c.c_mktsegment AS segment,
         n.n_name AS country, r.r_name AS region, n.n_name || chr(10) || r.r_name AS address
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW_PRODUCTS = f"""
raw_products AS (
  SELECT {product_code_sql('p_type', 'p_brand', 'p_partkey')} AS product_id,
         p_type AS category, p_brand AS sub_category, p_name AS product_name,
         CASE WHEN p_size = {MISALIGNED_SIZE} THEN p_brand
              ELSE CAST(p_retailprice AS VARCHAR) END AS price_per_product
  FROM part)"""

# The products of enrichment.
CATALOG = f"""
catalog AS (
  SELECT {product_code_sql('p_type', 'p_brand', 'p_partkey')} AS product_id,
         p_type AS category, p_brand AS sub_category
  FROM part WHERE p_size <= {CATALOG_MAX_SIZE})"""

# Candidate order lines before de-duplication (source rows, standardised names).
ORDER_LINES = f"""
order_lines AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
         o.o_orderdate AS order_ts, l.l_shipdate AS ship_ts,
         strftime(o.o_orderdate, {DATE_TEXT}) AS order_date_text,
         strftime(l.l_shipdate, {DATE_TEXT}) AS ship_date_text,
         o.o_custkey AS customer_id,
         CASE WHEN p.p_partkey IS NOT NULL THEN
           {product_code_sql('p.p_type', 'p.p_brand', 'l.l_partkey')} END AS product_id,
         CAST(l.l_quantity AS BIGINT) AS quantity, l.l_extendedprice AS price,
         l.l_discount AS discount,
         CAST(CAST(l.l_extendedprice AS DECIMAL(18,2))
              * (CAST(0.04 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))
           AS profit
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

RAW_ORDERS = """
raw_orders AS (
  SELECT * FROM order_lines
  QUALIFY row_number() OVER (PARTITION BY order_id, line_number
                             ORDER BY price, ship_ts) = 1)"""

ENRICHED_CUSTOMERS = f"""
enriched_customers AS (
  SELECT customer_id, {clean_name_sql('customer_name')} AS customer_name, segment, country,
         region, replace(address, chr(10), ', ') AS address
  FROM raw_customers)"""

ENRICHED_PRODUCTS = """
enriched_products AS (
  SELECT product_id, category, sub_category, product_name,
         TRY_CAST(price_per_product AS DOUBLE) AS price_per_product
  FROM raw_products)"""

ENRICHED_ORDERS = f"""
enriched_orders AS (
  SELECT o.order_id, o.line_number, CAST(o.order_ts AS DATE) AS order_date,
         CAST(o.ship_ts AS DATE) AS ship_date, o.customer_id, o.product_id, o.quantity,
         o.price, o.discount, CAST(ROUND(o.profit, 2) AS DOUBLE) AS profit,
         c.customer_name, c.country,
         COALESCE(p.category, {_case('substr(o.product_id, 1, 3)', CATEGORIES)})
           AS category,
         COALESCE(p.sub_category, {_case('substr(o.product_id, 5, 2)', SUB_CATEGORIES)})
           AS sub_category
  FROM raw_orders o
  LEFT JOIN enriched_customers c ON o.customer_id = c.customer_id
  LEFT JOIN catalog p ON o.product_id = p.product_id)"""

STAR = "WITH " + ",".join([RAW_CUSTOMERS, RAW_PRODUCTS, CATALOG, ORDER_LINES, RAW_ORDERS,
                           ENRICHED_CUSTOMERS, ENRICHED_PRODUCTS, ENRICHED_ORDERS])


def money_total_sql(c: str) -> str:
    return f"CAST(ROUND(SUM(CAST({c} AS DECIMAL(18,6))), 2) AS DOUBLE)"


ORACLE: dict[str, str] = {}

ORACLE["q_profit_by_year"] = STAR + f"""
SELECT CAST(year(order_date) AS INTEGER) AS year, {money_total_sql('profit')} AS total_profit,
       COUNT(*) AS order_count
FROM enriched_orders GROUP BY 1 ORDER BY 1"""

LINE_COLUMNS = """order_id, line_number, order_date_text AS order_date,
       ship_date_text AS ship_date, customer_id, product_id, quantity, price, discount,
       CAST(profit AS DOUBLE) AS profit"""

ENRICHED_COLUMNS = ("order_id", "line_number", "order_date", "ship_date", "customer_id",
                    "product_id", "quantity", "price", "discount", "profit", "customer_name",
                    "country", "category", "sub_category")

SUMMARY = STAR + f""",
summary AS (
  SELECT CAST(year(order_date) AS INTEGER) AS year, category, sub_category, customer_name,
         {money_total_sql('profit')} AS total_profit, COUNT(order_id) AS order_count,
         {money_total_sql('price')} AS total_revenue
  FROM enriched_orders GROUP BY ALL)"""

ORACLE.update({
    "q_standardize_columns": STAR + f"\nSELECT {LINE_COLUMNS} FROM order_lines",
    "q_trim_strings": STAR + """
SELECT customer_id, customer_name, segment, country, region, address FROM raw_customers""",
    "q_round_money": STAR + """
SELECT order_id, line_number, CAST(ROUND(profit, 2) AS DOUBLE) AS profit FROM order_lines""",
    "q_parse_date": STAR + """
SELECT order_id, line_number, CAST(order_ts AS DATE) AS order_date,
       CAST(ship_ts AS DATE) AS ship_date
FROM order_lines""",
    "q_try_cast_price": STAR + """
SELECT product_id, TRY_CAST(price_per_product AS DOUBLE) AS price_per_product FROM raw_products""",
    "q_normalize_newlines": "SELECT doc_id, replace(text, chr(10), ', ') AS text FROM documents",
    "q_clean_name_documents": f"SELECT doc_id, {clean_name_sql('text')} AS text FROM documents",
    "q_enriched_customers": STAR + "\nSELECT * FROM enriched_customers",
    "q_dedup_keep_one": STAR + f"\nSELECT {LINE_COLUMNS} FROM raw_orders",
    "q_duplicate_summary": STAR + """
SELECT order_id, line_number, COUNT(*) AS count FROM order_lines
GROUP BY order_id, line_number HAVING COUNT(*) > 1""",
    "q_null_summary": STAR + "\nSELECT " + ",\n       ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ENRICHED_COLUMNS)
        + "\nFROM enriched_orders",
    "q_derive_code": STAR + """
SELECT order_id, line_number, product_id, category, sub_category FROM enriched_orders""",
    "q_enrich_orders": STAR + "\nSELECT * FROM enriched_orders",
    "q_profit_summary": SUMMARY + "\nSELECT * FROM summary ORDER BY year, category, sub_category, customer_name",
    "q_profit_by_year_category": STAR + f"""
SELECT CAST(year(order_date) AS INTEGER) AS year, category,
       {money_total_sql('profit')} AS total_profit, COUNT(*) AS order_count
FROM enriched_orders GROUP BY ALL ORDER BY year, category""",
    "q_profit_by_customer": STAR + f"""
SELECT customer_id, customer_name, {money_total_sql('profit')} AS total_profit,
       COUNT(*) AS order_count
FROM enriched_orders GROUP BY ALL ORDER BY total_profit DESC, customer_id""",
    "q_profit_by_customer_year": STAR + f"""
SELECT customer_id, customer_name, CAST(year(order_date) AS INTEGER) AS year,
       {money_total_sql('profit')} AS total_profit, COUNT(*) AS order_count
FROM enriched_orders GROUP BY ALL ORDER BY customer_name, year, customer_id""",
    "q_top_n_groups": SUMMARY + """
SELECT * FROM summary
ORDER BY total_profit DESC NULLS LAST, year NULLS FIRST, category NULLS FIRST,
         sub_category NULLS FIRST, customer_name NULLS FIRST
LIMIT 10""",
    "q_reconcile": SUMMARY + """,
totals AS (
  SELECT (SELECT ROUND(SUM(CAST(profit AS DECIMAL(18,6))), 2) FROM enriched_orders) AS s,
         (SELECT ROUND(SUM(CAST(total_profit AS DECIMAL(18,6))), 2) FROM summary) AS a)
SELECT CAST(s AS DOUBLE) AS source_total, CAST(a AS DOUBLE) AS aggregate_total,
       s IS NOT DISTINCT FROM a AS matched
FROM totals""",
    "q_accepted_values": SUMMARY + f""",
seen AS (SELECT DISTINCT category FROM summary),
rules AS (
  SELECT 'accepted_values' AS rule, COUNT(*) AS checked,
         COUNT(*) FILTER (WHERE category IS NULL OR category NOT IN
             ({", ".join(f"'{c}'" for c in sorted(CATEGORIES.values()))})) AS failed
  FROM seen
  UNION ALL
  SELECT 'expected_values_present', {len(CATEGORIES)},
         {len(CATEGORIES)} - COUNT(*) FILTER (WHERE category IN
             ({", ".join(f"'{c}'" for c in sorted(CATEGORIES.values()))}))
  FROM seen)
SELECT rule, 'agg_profit_summary' AS subject, CAST(checked AS BIGINT) AS checked,
       CAST(failed AS BIGINT) AS failed, failed = 0 AS passed
FROM rules""",
    "q_distinct_domain": STAR + "\nSELECT DISTINCT category FROM enriched_orders",
})


def _row_rules_sql(table: str, subject: str, keys: list[str],
                   failing: dict[str, str]) -> tuple[str, str]:
    """CTE text and SELECT list (rule, subject, checked, failed) for
    ``quality.row_rules`` with a key."""
    k = ", ".join(keys)
    null_key = " OR ".join(f"{c} IS NULL" for c in keys)
    f_cols = "".join(f",\n         COUNT(*) FILTER (WHERE {cond}) AS f{i}"
                     for i, cond in enumerate(failing.values()))
    sums = "".join(f", SUM(f{i}) AS f{i}" for i in range(len(failing)))
    cte = f"""
pk_{table} AS (
  SELECT {k}, COUNT(*) AS n, COUNT(*) FILTER (WHERE {null_key}) AS nk{f_cols}
  FROM {table} GROUP BY {k}),
t_{table} AS (
  SELECT COALESCE(SUM(n), 0) AS r, COUNT(*) AS keys, COUNT(*) FILTER (WHERE n > 1) AS dup,
         SUM(nk) AS nk{sums}
  FROM pk_{table})"""
    sel = [
        f"SELECT 'not_empty' AS rule, '{subject}' AS subject, r AS checked, "
        f"CASE WHEN r = 0 THEN 1 ELSE 0 END AS failed FROM t_{table}",
        f"SELECT 'unique_key', '{subject}', keys, dup FROM t_{table}",
        f"SELECT 'null_key', '{subject}', r, nk FROM t_{table}",
    ] + [f"SELECT '{name}', '{subject}', r, f{i} FROM t_{table}"
         for i, name in enumerate(failing)]
    return cte, "\nUNION ALL ".join(sel)


def _rule_table(ctes: list[str], selects: list[str]) -> str:
    return (STAR + "," + ",".join(ctes) + """
SELECT rule, subject, CAST(COALESCE(checked, 0) AS BIGINT) AS checked,
       CAST(COALESCE(failed, 0) AS BIGINT) AS failed, COALESCE(failed, 0) = 0 AS passed
FROM (""" + "\nUNION ALL ".join(selects) + ") rules")


_ENRICHED_FAILING = {
    "null_category": "category IS NULL",
    "null_sub_category": "sub_category IS NULL",
    "unparsed_date": "order_date IS NULL OR ship_date IS NULL",
    "unrounded_profit": "profit <> ROUND(profit, 2)",
    "dirty_customer_name": "regexp_matches(customer_name, '[0-9@#$%^&*]')",
    "year_out_of_range": "NOT (year(order_date) BETWEEN {lo} AND {hi})",
    "unmatched_customer": "customer_name IS NULL",
}


def _quality_report_sql() -> str:
    failing = {k: v.format(lo=YEARS[0], hi=YEARS[1])
               for k, v in _ENRICHED_FAILING.items()}
    cte, sel = _row_rules_sql("enriched_orders", "enriched_orders",
                              ["order_id", "line_number"], failing)
    counts = """
counts AS (
  SELECT (SELECT COUNT(*) FROM raw_orders) AS l, (SELECT COUNT(*) FROM enriched_orders) AS r)"""
    selects = [
        sel,
        "SELECT 'not_empty', 'enriched_products', COUNT(*), CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END "
        "FROM raw_products",
        "SELECT 'unparsed_price', 'enriched_products', COUNT(*), COUNT(*) FILTER (WHERE price_per_product "
        "IS NOT NULL AND TRY_CAST(price_per_product AS DOUBLE) IS NULL) FROM raw_products",
        "SELECT 'row_count_match', 'orders after joins', l, abs(l - r) FROM counts",
        "SELECT 'required_columns', 'enriched_orders', 8, 0",
        "SELECT 'column_types', 'enriched_orders', 2, 0",
        f"SELECT 'column_naming', 'enriched_orders', {len(ENRICHED_COLUMNS)}, 0",
    ]
    return _rule_table([cte, counts], selects)


def _raw_quality_sql() -> str:
    ctes, selects = [], []
    for table, keys in (("raw_customers", ["customer_id"]), ("raw_products", ["product_id"]),
                        ("raw_orders", ["order_id", "line_number"])):
        failing = {"unmatched_order": "customer_id IS NULL", "unmatched_part": "product_id IS NULL"}
        cte, sel = _row_rules_sql(table, table, keys, failing if table == "raw_orders" else {})
        ctes.append(cte)
        selects.append(sel)
    selects += [
        "SELECT 'required_columns', 'raw_customers', 5, 0",
        "SELECT 'required_columns', 'raw_products', 4, 0",
        "SELECT 'required_columns', 'raw_orders', 6, 0",
        "SELECT 'column_naming', 'raw_customers', 6, 0",
        "SELECT 'column_naming', 'raw_products', 5, 0",
        "SELECT 'column_naming', 'raw_orders', 10, 0",
    ]
    return _rule_table(ctes, selects)


ORACLE["q_quality_report"] = _quality_report_sql()
ORACLE["q_raw_quality"] = _raw_quality_sql()

ORACLE["q_csv_roundtrip"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def _dependency_sql(determinant: str, dependent: str) -> str:
    return f"""
SELECT '{determinant} -> {dependent}' AS dependency, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS "rows",
       COUNT(*) AS "groups", COUNT(*) FILTER (WHERE v > 1) AS violating_groups,
       CAST(COALESCE(SUM(n) FILTER (WHERE v > 1), 0) AS BIGINT) AS violating_rows,
       CAST(COALESCE(SUM(n - m), 0) AS BIGINT) AS removed_rows
FROM (SELECT SUM(c) AS n, MAX(c) AS m, COUNT(*) AS v
      FROM (SELECT {determinant} AS x, {dependent} AS y, COUNT(*) AS c FROM enriched_orders GROUP BY ALL)
      GROUP BY x)"""


ORACLE["q_dependencies"] = STAR + " UNION ALL ".join(
    _dependency_sql(*x) for x in (("product_id", "category"), ("product_id", "sub_category"),
                                  ("sub_category", "category")))
_QUARANTINE = {"null_category": "category IS NULL", "unparsed_date": "order_date IS NULL OR ship_date IS NULL",
               "unmatched_customer": "customer_name IS NULL", "shipped_early": "ship_date < order_date",
               "heavy_loss": "profit < -1000", "bulk": "quantity >= 49"}
ORACLE["q_quarantine"] = STAR + """
SELECT * FROM (SELECT order_id, line_number, concat_ws(',', """ + ", ".join(
    f"CASE WHEN {condition} THEN '{name}' END" for name, condition in _QUARANTINE.items()) + """) AS failed_rules
FROM enriched_orders) WHERE failed_rules <> ''"""
ORACLE["q_verified_write"] = STAR + """
SELECT COUNT(*) AS rows_written, COUNT(*) AS rows_stored, TRUE AS matched FROM enriched_orders"""
ORACLE["q_profile"] = STAR + " UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT(*) AS "rows", COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls,
       CAST(MIN({c}) AS VARCHAR) AS least, CAST(MAX({c}) AS VARCHAR) AS greatest,
       COUNT({c}) > 0 AND COUNT(DISTINCT {c}) = COUNT({c}) AS is_key
FROM raw_customers""" for c in ("customer_id", "customer_name", "segment", "country", "region", "address"))
ORACLE["q_stream_dedup"] = ORACLE["q_dedup_keep_one"]
ORACLE["q_bucketed_profit_by_customer"] = ORACLE["q_profit_by_customer"]
ORACLE["q_incremental_summary"] = SUMMARY + "\nSELECT * FROM summary"
ORACLE["q_csv_split"] = ORACLE["q_csv_roundtrip"]
ORACLE["q_json_array_split"] = ORACLE["q_standardize_columns"]
ORACLE["q_json_roundtrip"] = ORACLE["q_standardize_columns"]
ORACLE["q_json_array"] = ORACLE["q_standardize_columns"]
ORACLE["q_stream_enriched_orders"] = STAR + """
SELECT order_id, line_number, order_date, customer_id, customer_name, country FROM enriched_orders"""
ORACLE["q_overwrite_idempotent"] = ORACLE["q_enrich_orders"]
ORACLE["q_raw_layer"] = STAR + """
SELECT 'raw_customers' AS "table", COUNT(*) AS "rows" FROM raw_customers
UNION ALL SELECT 'raw_products', COUNT(*) FROM raw_products
UNION ALL SELECT 'raw_orders', COUNT(*) FROM raw_orders"""

for _name in ("profit_by_year", "profit_by_year_category", "profit_by_customer",
              "profit_by_customer_year"):
    ORACLE[f"q_sql_{_name}"] = ORACLE[f"q_{_name}"]

ORACLE["q_csv_products_raw"] = STAR + "\nSELECT * FROM raw_products"
