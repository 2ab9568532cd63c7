"""Grouped measures, ordered reports and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.parsing import MONEY_PRECISION, SUM_SCALE, money


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_total(c: str | Column, scale: int = 2) -> Column:
    """Sum of an amount, rounded once to ``scale`` places, returned as double.

    Amounts are summed as decimals (``SUM_SCALE`` places, so inputs are not
    rounded row by row), which makes the total independent of the order in
    which partial sums are combined; a double sum is not."""
    return F.round(F.sum(money(c, SUM_SCALE)), scale).cast("double")


def summarize(df: DataFrame, keys: Sequence[str | Column],
              measures: Mapping[str, Column],
              order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """``GROUP BY keys`` with named measures, optionally ordered.

    Spark plans a partial hash aggregate before the shuffle and a final one
    after, so each task ships at most one row per group it saw."""
    out = df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    return out.orderBy(*order_by) if order_by else out


def top_n(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in ``order_by`` order (``TakeOrderedAndProject``:
    each task keeps its own n best, the driver merges n per task)."""
    return df.orderBy(*order_by).limit(n)


# Measures of the sales reports.
def profit_measures(count_column: str | None = None,
                    revenue_column: str | None = None,
                    profit_column: str = "profit") -> dict[str, Column]:
    """``total_profit``, ``order_count`` (``count(col)`` or ``count(*)``) and
    optionally ``total_revenue``."""
    m = {
        "total_profit": money_total(profit_column),
        "order_count": F.count(count_column) if count_column else F.count(F.lit(1)),
    }
    if revenue_column:
        m["total_revenue"] = money_total(revenue_column)
    return m


SUMMARY_KEYS = ("year", "category", "sub_category", "customer_name")


def profit_summary(enriched: DataFrame, keys: Sequence[str] = SUMMARY_KEYS,
                   date_column: str = "order_date", ordered: bool = False,
                   distinct_orders: bool = False) -> DataFrame:
    """Profit, order-line count and revenue per year and the given keys.

    ``order_count`` counts order lines with an order id (lines, not distinct
    orders); ``total_revenue`` is the sum of line prices. ``distinct_orders``
    adds the number of distinct order ids per group (an extra
    de-duplication inside the aggregate, so it is opt-in)."""
    with_year = enriched.withColumn("year", F.year(date_column))
    measures = profit_measures(count_column="order_id", revenue_column="price")
    if distinct_orders:
        measures["distinct_orders"] = F.count_distinct("order_id")
    return summarize(with_year, list(keys), measures,
                     order_by=list(keys) if ordered else None)


def profit_report(enriched: DataFrame, by: Sequence[str], order_by: Sequence[str | Column],
                  date_column: str = "order_date") -> DataFrame:
    """A profit report: ``by`` may name ``year`` (taken from ``date_column``)."""
    base = enriched.withColumn("year", F.year(date_column)) if "year" in by else enriched
    return summarize(base, list(by), profit_measures(), order_by=order_by)


# The four reports: grouping columns and ordering ("-" = descending). The
# customer reports end with customer_id so namesakes and equal totals come
# out in a fixed order.
REPORT_SPECS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "profit_by_year": (("year",), ("year",)),
    "profit_by_year_category": (("year", "category"), ("year", "category")),
    "profit_by_customer": (("customer_id", "customer_name"), ("-total_profit", "customer_id")),
    "profit_by_customer_year": (("customer_id", "customer_name", "year"),
                                ("customer_name", "year", "customer_id")),
}


def _order(spec: tuple[str, ...]) -> list[Column]:
    return [F.desc(o[1:]) if o.startswith("-") else F.col(o) for o in spec]


def report(enriched: DataFrame, name: str) -> DataFrame:
    by, order = REPORT_SPECS[name]
    return profit_report(enriched, by, _order(order))


def report_sql(view: str, name: str, date_column: str = "order_date") -> str:
    """The same report as SQL text over a table or view (``spark.sql``)."""
    by, order = REPORT_SPECS[name]
    year = f"YEAR({date_column})"
    dims = [f"{year} AS year" if b == "year" else b for b in by]
    groups = [year if b == "year" else b for b in by]
    orders = [f"{o[1:]} DESC" if o.startswith("-") else o for o in order]
    return (f"SELECT {', '.join(dims)},\n"
            f"       CAST(ROUND(SUM(CAST(profit AS DECIMAL({MONEY_PRECISION},{SUM_SCALE}))), 2)"
            f" AS DOUBLE) AS total_profit,\n"
            f"       COUNT(*) AS order_count\n"
            f"FROM {view}\nGROUP BY {', '.join(groups)}\nORDER BY {', '.join(orders)}")


def profit_by_year(enriched: DataFrame) -> DataFrame:
    return report(enriched, "profit_by_year")


def profit_by_year_category(enriched: DataFrame) -> DataFrame:
    return report(enriched, "profit_by_year_category")


def profit_by_customer(enriched: DataFrame) -> DataFrame:
    return report(enriched, "profit_by_customer")


def profit_by_customer_year(enriched: DataFrame) -> DataFrame:
    return report(enriched, "profit_by_customer_year")
