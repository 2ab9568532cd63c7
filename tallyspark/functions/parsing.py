"""Lenient parsing and exact money arithmetic.

Bad input becomes NULL instead of failing the job (ANSI mode is on by
default in Spark 4, so plain ``cast``/``to_date`` would raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day/month/year layout of the order and ship dates.
DEFAULT_DATE_FORMAT = "d/M/yyyy"

# Money is carried as decimal so sums and rounding are exact and do not depend
# on the order rows arrive in; 18 digits hold any order-line amount.
MONEY_PRECISION = 18
# Places kept while summing amounts; totals are rounded once at the end.
SUM_SCALE = 6
# A total is wider than any one amount.
TOTAL_PRECISION = 38


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: str | Column) -> Column:
    """String → double; text that is not a number becomes NULL."""
    return _col(c).try_cast("double")


def parse_date(c: str | Column, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    """String → date with ``fmt``; anything that does not fit becomes NULL."""
    return F.try_to_date(_col(c), fmt)


def money(c: str | Column, scale: int = 2) -> Column:
    """A double or decimal amount as ``decimal(18, scale)``."""
    return _col(c).cast(f"decimal({MONEY_PRECISION},{scale})")


def total(c: str | Column, scale: int = SUM_SCALE) -> Column:
    """Exact sum of a column of amounts, or of totals of amounts. Totals reach
    beyond what an order line can, so they are carried with all 38 digits."""
    return F.sum(_col(c).cast(f"decimal({TOTAL_PRECISION},{scale})"))


def round_money(c: str | Column, scale: int = 2) -> Column:
    """Round half away from zero to ``scale`` places, keeping the input type."""
    return F.round(_col(c), scale)
